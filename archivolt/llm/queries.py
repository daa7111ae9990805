"""Queries of the training-data problems: name -> callable(spark, directory), and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from archivolt.llm import encoding, golden, language, leaks, names, neighbours, packing, pieces, scans, subjects
from archivolt.llm.sql import SQL
from archivolt.session import table

Query = Callable[[SparkSession, str], DataFrame]


def _with(fn: Callable[..., DataFrame], *names: str) -> Query:
    """A query that hands whole tables to an operator with its production parameters."""
    return lambda spark, sf_dir: fn(*(table(spark, sf_dir, n) for n in names))


_GROUPS = ("duplicate_groups", "document_records", "extractor_profiles", "document_path_events")

_SUBJECTS = ("documents", "subject_labels", "evaluation_items", "subjects")


def queries() -> dict[str, Query]:
    return {
        "p1_found": _with(language.found, "documents", "document_records", "normalized_documents"),
        "p1_labels": _with(language.labels, "documents", "document_records"),
        "p1_stretches": _with(language.stretches, "documents", "document_records"),
        "p2_found": _with(neighbours.found, "vector_rows", "model_profiles"),
        "p2_neighbours": _with(neighbours.neighbours, "vector_rows", "model_profiles"),
        "p3_found": _with(names.found, "aliases"),
        "p3_entities": _with(names.entities, "aliases"),
        "p4_found": _with(golden.found, *_GROUPS),
        "p4_golden": _with(golden.golden, *_GROUPS),
        "p5_found": _with(pieces.found, "chunks", "chunk_profiles"),
        "p5_pieces": _with(pieces.pieces, "chunks", "chunk_profiles"),
        "p6_found": _with(encoding.found, "chunks", "document_records"),
        "p6_repaired": _with(encoding.repaired, "chunks", "document_records"),
        "p7_found": _with(scans.found, "chunks", "document_records"),
        "p7_repaired": _with(scans.repaired, "chunks", "document_records"),
        "p8_packing": _with(packing.pack, "documents", "model_profiles"),
        "p8_fill": lambda spark, d: packing.fill(packing.pack(table(spark, d, "documents"), table(spark, d, "model_profiles"))),
        "p10_found": _with(subjects.found, *_SUBJECTS),
        "p10_subjects": _with(subjects.subjects, *_SUBJECTS),
        "p10_composition": _with(subjects.composition, *_SUBJECTS),
        "p10_held_out": _with(subjects.held_out, *_SUBJECTS),
        "p10_top_terms": _with(subjects.top_terms, *_SUBJECTS),
        "p9_found": _with(leaks.found, "documents", "evaluation_items"),
        "p9_leaks": _with(leaks.leaks, "documents", "evaluation_items"),
    }


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
