"""The operators' queries and, where SQL can express one, its DuckDB form."""

from feedlens.llm import (alignment, chat, decontaminate, exact_dedup, fim, language, neighbours, packing, pages, quality,
                          secrets, simhash, toxicity)

QUERIES = {
    "op1_language": language.op1_language,
    "op2_chat_format": chat.op2_chat_format,
    "op3_quality": quality.op3_quality,
    "op4_secrets": secrets.op4_secrets,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_main_text": pages.op6_main_text,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_simhash": simhash.op8_simhash,
    "op9_packing": packing.op9_packing,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_neighbours": neighbours.op11_neighbours,
    "op12_fill_in_middle": fim.op12_fill_in_middle,
    "op13_tokenizer_alignment": alignment.op13_tokenizer_alignment,
}

SQL = {
    "op2_chat_format": chat.OP2_SQL,
    "op7_exact_dedup": exact_dedup.OP7_SQL,
    "op12_fill_in_middle": fim.OP12_SQL,
}
