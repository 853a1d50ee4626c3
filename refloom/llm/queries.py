"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from . import bpe, chat, embeddings, langid, mixing, simhash, spotsigs, suffix_dedup, token_store, warc

QUERIES = {
    "op1_chat": chat.op1_chat,
    "op2_simhash": simhash.op2_simhash,
    "op3_warc": warc.op3_warc,
    "op4_token_store": token_store.op4_token_store,
    "op5_mixing": mixing.op5_mixing,
    "op6_bpe": bpe.op6_bpe,
    "op7_embeddings": embeddings.op7_embeddings,
    "op8_langid": langid.op8_langid,
    "op9_spotsigs": spotsigs.op9_spotsigs,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
}

ORACLE_SQL = {
    "op1_chat": chat.OP1_SQL,
    "op3_warc": warc.OP3_SQL,
    "op5_mixing": mixing.OP5_SQL,
    "op7_embeddings": embeddings.OP7_SQL,
    "op9_spotsigs": spotsigs.OP9_SQL,
    "op10_suffix_dedup": suffix_dedup.OP10_SQL,
}
