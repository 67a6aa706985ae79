"""The named queries of this subpackage, each over its whole table, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillstream.llm import (ann, bpe, contamination, idfiles, langid, lattice, lines, neardup, pii, repeats,
                            toxicity, turns, whitening)


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_near_dedup(spark, sf_dir):
    return neardup.groups(table(spark, sf_dir, "documents"), size=3, percent=85)


def op2_language_id(spark, sf_dir):
    return langid.predictions(table(spark, sf_dir, "documents"))


def op3_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), word_vocabulary())


def op4_lattice_scores(spark, sf_dir):
    return lattice.scores(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("piece_bpe_32k.model"))


def op5_nearest(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op6_decontamination(spark, sf_dir):
    return contamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_pii(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark, sf_dir):
    return lines.report(table(spark, sf_dir, "documents"))


def op9_repeats(spark, sf_dir):
    return repeats.report(table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_id_files(spark, sf_dir):
    return idfiles.report(table(spark, sf_dir, "documents"), word_vocabulary())


def op12_turn_repair(spark, sf_dir):
    return turns.report(table(spark, sf_dir, "conversations"))


def op13_whitening(spark, sf_dir):
    return whitening.report(table(spark, sf_dir, "embeddings"))


def entries() -> dict[str, Entry]:
    return {
        "op1_near_dedup": Entry(op1_near_dedup),
        "op2_language_id": Entry(op2_language_id),
        "op3_bpe": Entry(op3_bpe),
        "op4_lattice_scores": Entry(op4_lattice_scores),
        "op5_nearest": Entry(op5_nearest),
        "op6_decontamination": Entry(op6_decontamination, contamination.REPORT_SQL),
        "op7_pii": Entry(op7_pii),
        "op8_line_dedup": Entry(op8_line_dedup, lines.REPORT_SQL),
        "op9_repeats": Entry(op9_repeats),
        "op10_toxicity": Entry(op10_toxicity),
        "op11_id_files": Entry(op11_id_files),
        "op12_turn_repair": Entry(op12_turn_repair),
        "op13_whitening": Entry(op13_whitening),
    }
