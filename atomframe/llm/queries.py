"""Queries of the training-data operators and their SQL, where SQL can express them."""

from atomframe.llm import chat, decontaminate, hmm, jaccard, langid, merkle, packing, quality, repeats, search, secrets, tokenfiles, warc

QUERIES = {
    "op1_hmm": hmm.op1_hmm,
    "op2_jaccard": jaccard.op2_jaccard,
    "op3_secrets": secrets.op3_secrets,
    "op4_repeats": repeats.op4_repeats,
    "op5_token_files": tokenfiles.op5_token_files,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_packing": packing.op7_packing,
    "op8_chat": chat.op8_chat,
    "op9_langid": langid.op9_langid,
    "op10_quality": quality.op10_quality,
    "op11_search": search.op11_search,
    "op12_warc": warc.op12_warc,
    "op13_merkle": merkle.op13_merkle,
}

ORACLES = {
    "op2_jaccard": jaccard.SQL,
    "op6_decontaminate": decontaminate.SQL,
    "op8_chat": chat.SQL,
    "op10_quality": quality.SQL,
    "op11_search": search.SQL,
    "op12_warc": warc.SQL,
    "op13_merkle": merkle.SQL,
}
