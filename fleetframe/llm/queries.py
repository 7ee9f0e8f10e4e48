"""Registered queries of this folder: ``name -> (spark, sf_dir) -> DataFrame``, and their SQL."""

from __future__ import annotations

from fleetframe.llm.decontaminate import op9_decontaminate
from fleetframe.llm.licenses import op4_licenses
from fleetframe.llm.lines import OP8_SQL, op8_line_dedup
from fleetframe.llm.neighbours import OP6_SQL, op6_neighbours
from fleetframe.llm.passages import OP11_SQL, op11_passages
from fleetframe.llm.pieces import op5_sentencepiece
from fleetframe.llm.quality import op10_quality
from fleetframe.llm.ranked import OP12_SQL, op12_ranked
from fleetframe.llm.secrets import op7_secrets
from fleetframe.llm.simhash import op3_simhash
from fleetframe.llm.suffix import op2_suffix_dedup
from fleetframe.llm.toxicity import op1_toxicity
from fleetframe.llm.whitening import op13_whitening

REGISTRY = {
    "op1_toxicity": op1_toxicity,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_simhash": op3_simhash,
    "op4_licenses": op4_licenses,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_neighbours": op6_neighbours,
    "op7_secrets": op7_secrets,
    "op8_line_dedup": op8_line_dedup,
    "op9_decontaminate": op9_decontaminate,
    "op10_quality": op10_quality,
    "op11_passages": op11_passages,
    "op12_ranked": op12_ranked,
    "op13_whitening": op13_whitening,
}

#: DuckDB SQL where it can express the operator; the others are tested against brute force.
SQL: dict[str, str] = {
    "op6_neighbours": OP6_SQL,
    "op8_line_dedup": OP8_SQL,
    "op11_passages": OP11_SQL,
    "op12_ranked": OP12_SQL,
}
