"""The queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsegrain.llm.collocations import OP13_SQL, op13_collocations
from pulsegrain.llm.decontamination import op8_decontamination
from pulsegrain.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from pulsegrain.llm.html_extraction import op5_html_extraction
from pulsegrain.llm.language_id import op1_language_id
from pulsegrain.llm.license_scan import op10_license_scan
from pulsegrain.llm.ngram_join import op3_ngram_join
from pulsegrain.llm.packing import op4_packing
from pulsegrain.llm.periodic_runs import op11_periodic_runs
from pulsegrain.llm.pii_surrogates import op2_pii_surrogates
from pulsegrain.llm.sharding import op6_sharding
from pulsegrain.llm.suffix_dedup import OP12_SQL, op12_suffix_dedup
from pulsegrain.llm.toxicity import op7_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_ngram_join": op3_ngram_join,
    "op4_packing": op4_packing,
    "op5_html_extraction": op5_html_extraction,
    "op6_sharding": op6_sharding,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_collocations": op13_collocations,
}
SQL: dict[str, str] = {"op9_exact_dedup": OP9_SQL, "op12_suffix_dedup": OP12_SQL, "op13_collocations": OP13_SQL}
