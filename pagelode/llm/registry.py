"""Queries of the training-data operators by name, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagelode.llm import addresses, canonical, entities, mixing, sentences, survivor, tokens, variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": variants.p1_found,
    "p2_found": survivor.p2_found,
    "p2_survivors": survivor.p2_survivors,
    "p3_found": addresses.p3_found,
    "p3_rewrites": addresses.p3_rewrites,
    "p4_found": canonical.p4_found,
    "p5_found": entities.p5_found,
    "p5_matches": entities.p5_matches,
    "p5_reliability": entities.p5_reliability,
    "p6_ids": tokens.p6_ids,
    "p6_round_trip": tokens.p6_round_trip,
    "p7_mix": mixing.p7_mix,
    "p7_shares": mixing.p7_shares,
    "p8_found": sentences.p8_found,
}
ORACLES: dict[str, str] = {}
