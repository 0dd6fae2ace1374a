"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from ..session import shipped
from . import decontaminate, html_extract, jaccard_join, license_scan, lm_scoring, oracles, packing, quality_classifier, quality_rules, toxicity, warc

QUERIES = {
    name: shipped(query)
    for name, query in {
        "op1_quality_classifier": quality_classifier.query,
        "op2_lm_scoring": lm_scoring.query,
        "op3_jaccard_join": jaccard_join.query,
        "op4_quality_rules": quality_rules.query,
        "op5_packing": packing.query,
        "op6_html_extract": html_extract.query,
        "op7_license_scan": license_scan.query,
        "op8_decontaminate": decontaminate.query,
        "op9_toxicity": toxicity.query,
        "op10_warc": warc.query,
    }.items()
}
ORACLES = {
    "op3_jaccard_join": oracles.JACCARD_JOIN,
    "op4_quality_rules": oracles.QUALITY_RULES,
    "op7_license_scan": oracles.LICENSE_SCAN,
    "op8_decontaminate": decontaminate.ORACLE,
    "op10_warc": oracles.WARC,
}
