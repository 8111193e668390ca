"""The registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import functools
import os

from . import host_rules, merkle_manifest, mixing, ngram_join, packing, permutation_index, pii, quality_discriminant, spelling_variants, toxicity, training_order, unit_dedup, url_rules

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def with_package(query):
    """Let Python workers of a local session import this package from where the driver did."""

    @functools.wraps(query)
    def run(spark, *args):
        known = spark.sparkContext.environment
        paths = known.get("PYTHONPATH", "").split(os.pathsep)
        if _ROOT not in paths:
            known["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
        return query(spark, *args)

    return run


QUERIES = {
    query.__name__: with_package(query)
    for query in (
        training_order.op1_training_order,
        ngram_join.op2_ngram_join,
        mixing.op3_mixing,
        url_rules.op4_url_rules,
        toxicity.op5_toxicity,
        unit_dedup.op6_unit_dedup,
        packing.op7_packing,
        host_rules.op8_host_rules,
        permutation_index.op9_permutation_index,
        pii.op10_pii,
        merkle_manifest.op11_merkle_manifest,
        quality_discriminant.op12_quality_discriminant,
        spelling_variants.op13_spelling_variants,
    )
}

ORACLE = {
    "op4_url_rules": url_rules.OP4_SQL,
    "op8_host_rules": host_rules.OP8_SQL,
    "op11_merkle_manifest": merkle_manifest.OP11_SQL,
    "op13_spelling_variants": spelling_variants.OP13_SQL,
}
