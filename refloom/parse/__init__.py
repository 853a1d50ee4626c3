"""Parsers of publisher reference files, run in Arrow batches over the files of a DataFrame."""

from .frames import parse_blocks, parse_files  # noqa: F401
from .registry import PARSERS, parser_for, register_parser  # noqa: F401
