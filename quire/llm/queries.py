"""The registered queries of this subpackage and their SQL."""

from quire.llm import bpe, jaccard, langid, linededup, mixing, suffixdedup, tokencount, topk, warc, webp

QUERIES = {
    "op1_langid": langid.op1_langid,
    "op2_mixing": mixing.op2_mixing,
    "op3_suffixdedup": suffixdedup.op3_suffixdedup,
    "op4_bpe": bpe.op4_bpe,
    "op5_jaccard": jaccard.op5_jaccard,
    "op6_linededup": linededup.op6_linededup,
    "op7_webp": webp.op7_webp,
    "op8_topk": topk.op8_topk,
    "op9_warc": warc.op9_warc,
    "op10_tokencount": tokencount.op10_tokencount,
}
SQL = {**topk.SQL, **warc.SQL}
