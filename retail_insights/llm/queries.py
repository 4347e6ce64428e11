"""The registered queries of this package, and their DuckDB texts."""

from __future__ import annotations

from retail_insights.llm.bin_packing import op9_best_fit_packing
from retail_insights.llm.decontaminate import op3_benchmark_passages
from retail_insights.llm.oracle import ORACLE_SQL  # noqa: F401
from retail_insights.llm.periodic_runs import op13_periodic_runs
from retail_insights.llm.pii_boost import op10_personal_data
from retail_insights.llm.ppm_language import op2_ppm_language
from retail_insights.llm.quality_lines import op1_quality_rules
from retail_insights.llm.ranked_search import op12_ranked_search
from retail_insights.llm.secret_crf import op8_secret_scan
from retail_insights.llm.simhash_covering import op4_simhash_components
from retail_insights.llm.substring_fm import op11_substring_dedup
from retail_insights.llm.suffix_dedup import op6_suffix_dedup
from retail_insights.llm.token_records import op7_token_records
from retail_insights.llm.url_rules import op5_url_filters

QUERIES = {f.__name__: f for f in [
    op1_quality_rules, op2_ppm_language, op3_benchmark_passages, op4_simhash_components,
    op5_url_filters, op6_suffix_dedup, op7_token_records, op8_secret_scan, op9_best_fit_packing,
    op10_personal_data, op11_substring_dedup, op12_ranked_search, op13_periodic_runs]}
