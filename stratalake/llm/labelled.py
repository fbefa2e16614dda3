"""Bounded samples of labelled documents for fitting a classifier, and the folds they may come from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.keys import named
from stratalake.llm.common import id_and_text


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(named(id_col).cast("string").cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label_col: str, allowed: Column, per_class: int, max_chars: int | None, id_col: str = "doc_id", text_col: str = "text") -> dict[int, list[str]]:
    """Texts of at most ``per_class`` labelled rows of each class, by hash of the id, to fit a model on the driver.

    ``allowed`` tells which labels may be used. Texts are whole unless ``max_chars`` is given. An id with both labels is
    left out; of several texts of one id the one with the smallest hash is taken.
    """
    usable = labels.filter(allowed & named(label_col).isin(0, 1) & named(id_col).isNotNull())
    usable = usable.groupBy(named(id_col).cast("long").alias("_id")).agg(F.min(label_col).alias("_label"), F.max(label_col).alias("_other"))
    usable = usable.filter("_label = _other").select("_id", "_label")
    chosen = reduce(DataFrame.union, [usable.filter(F.col("_label") == c).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for c in (0, 1)])
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))  # 2 * per_class ids
    text = F.col("text") if max_chars is None else F.substring("text", 1, max_chars)
    found = rows.groupBy("doc_id", "_label").agg(F.min_by(text, F.struct(F.xxhash64("text"), "text"))).collect()
    found.sort(key=lambda r: r[0])
    return {c: [r[2] for r in found if r[1] == c] for c in (0, 1)}


def share_of_ones(texts: dict[int, list[str]]) -> float:
    n = len(texts[0]) + len(texts[1])
    return len(texts[1]) / n if n else 0.5
