from . import library, parsing, registry  # noqa: F401
