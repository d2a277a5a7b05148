"""Language identification with bit-sliced Bloom filters over character n-grams.

Every language has a Bloom filter of its common n-grams. The filters are stored bit-sliced:
row i of one table holds bit i of all of them, so the rows of an n-gram's hashes, ANDed,
are the bitmask of all languages that contain it. A text's n-grams are counted by
language (a popcount of each mask bit), the expected false positives are taken off
and the language with the largest corrected share is decided on.

An n-gram belongs to a language if its share there is at least ``LEAST_SHARE``, so a
language has at most 1 / LEAST_SHARE of each order, and the table a proven size. The
shares come from a bounded sample, ``ROWS`` rows of each language at most twice over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlens.llm.common import chunks, id_remainder, mix64, read_table, text_udf

ORDERS = (3, 4)
ROWS = 2_000
LEAST_SHARE = 5e-5
HASHES, BITS_PER_GRAM = 3, 12
SPLIT, HELD_OUT = 4, 2
UNKNOWN = "und"
_PRIME = np.uint64(0x9E3779B97F4A7C15)


_LETTERS = np.array([chr(c).isalpha() for c in range(0x110000)])


def ngrams(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the n-grams of all texts, number of each text's): windows of ``order``
    over lower-case letters, with one blank for whatever stands between words."""
    codes = [np.frombuffer(("\n" + t.lower() + "\n").encode("utf-32-le"), np.uint32) for t in texts]
    whole = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
    whole = np.where(_LETTERS[whole], whole, 0).astype(np.uint64)
    keep = whole > 0
    keep[1:] |= whole[:-1] > 0   # the first blank after a letter stays
    starts = np.cumsum([0, *map(len, codes)])
    keep[starts[:-1]] = True     # and the blank before a text
    kept = np.concatenate(([0], np.cumsum(keep)))[starts]
    whole = whole[keep]
    n = len(whole) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(order):
        h = h * _PRIME + whole[k:k + n]
    inside = np.zeros(n, bool)
    counts = np.maximum(np.diff(kept) - order + 1, 0)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(kept[:-1], n), 1)
    np.add.at(edge, np.minimum(kept[:-1] + counts, n), -1)
    inside = np.cumsum(edge[:-1]) > 0
    return mix64(h[inside]), counts


class LanguageFilters:
    """The bit-sliced filters of one order: a word of mask bits (or several) a row."""

    def __init__(self, order: int, grams: list[np.ndarray]):
        self.order, self.languages = order, len(grams)
        size = 1 << max(10, int(np.ceil(np.log2(BITS_PER_GRAM * max(1, max(map(len, grams), default=1))))))
        self.words = -(-self.languages // 64)
        kind = np.uint8 if self.languages <= 8 else np.uint16 if self.languages <= 16 else np.uint64
        self.table = np.zeros((self.words, size), kind)
        for k, g in enumerate(grams):
            for rows in self._rows(g):
                self.table[k // 64, rows] |= kind(1 << k % 64)
        filled = [((self.table[k // 64] >> kind(k % 64)) & kind(1)).mean() for k in range(self.languages)]
        self.false_positive = np.array(filled) ** HASHES

    def _rows(self, grams: np.ndarray) -> Iterator[np.ndarray]:
        for k in range(HASHES):
            yield (grams >> np.uint64(21 * k)).astype(np.int64) & (self.table.shape[1] - 1)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """(words, n-grams) bitmasks of the languages that contain each n-gram."""
        out = None
        for rows in self._rows(grams):
            found = self.table[:, rows]
            out = found if out is None else out & found
        return out

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages) corrected shares of each text's n-grams, and their numbers."""
        grams, counts = ngrams(texts, self.order)
        masks, ends = self.masks(grams), np.cumsum(counts)
        hits = np.zeros((len(texts), self.languages))
        for k in range(self.languages):
            bit = (masks[k // 64] >> masks.dtype.type(k % 64)) & masks.dtype.type(1)
            total = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
            hits[:, k] = total[ends] - total[ends - counts]
        n = np.maximum(counts, 1)[:, None]
        return np.clip((hits / n - self.false_positive) / (1 - self.false_positive), 0, 1), counts


class LanguageModel:
    def __init__(self, languages: list[str], filters: list[LanguageFilters]):
        self.languages, self.filters = languages, filters

    def predict(self, texts: list[str | None]) -> list[dict]:
        texts = [t or "" for t in texts]
        letters = [any(map(str.isalpha, t)) for t in texts]
        if not self.languages:
            return [{"lang_pred": UNKNOWN, "score": 0.0}] * len(texts)
        shares = sum(f.shares(texts)[0] for f in self.filters) / len(self.filters)
        best = shares.argmax(axis=1)
        total = shares.sum(axis=1)
        part = np.where(total > 0, shares.max(axis=1) / np.maximum(total, 1e-12), 0.0)
        return [{"lang_pred": self.languages[b] if has else UNKNOWN, "score": float(s) if has else 0.0}
                for has, b, s in zip(letters, best, part)]


def _gram_counts(order: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang")["text"]:
                texts = part.tolist()
                for a, b in chunks([len(t) for t in texts]):
                    grams, n = np.unique(ngrams(texts[a:b], order)[0], return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": grams.view(np.int64), "n": n})
    return count


def train_language(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = ROWS,
                   least_share: float = LEAST_SHARE, orders: tuple[int, ...] = ORDERS) -> LanguageModel:
    """Filters from the rows with a text and a language that are not held out."""
    known = (docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
             .filter("text IS NOT NULL AND lang IS NOT NULL").filter(id_remainder("__id", SPLIT) != HELD_OUT))
    place = F.pmod(F.xxhash64(F.lit(3), "__id", "text"), F.lit(1_000_000)) / 1_000_000
    sizes = {r["lang"]: (r["n"], r["first"]) for r in known.groupBy("lang").agg(F.count("*").alias("n"), F.min(place).alias("first")).collect()}
    if not sizes:
        return LanguageModel([], [])
    # the rows whose hash comes first, one at least
    share = F.create_map(*[F.lit(x) for name, (n, first) in sizes.items() for x in (name, max(first, min(1.0, rows / n)))])
    languages = sorted(sizes)
    sample = known.filter(place <= share[F.col("lang")]).select("lang", "text")
    filters = []
    for order in orders:
        counts = (sample.mapInPandas(_gram_counts(order), "lang string, gram long, n long")
                  .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
        total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
        common = (counts.join(F.broadcast(total), "lang").filter(F.col("n") >= least_share * F.col("total"))
                  .groupBy("lang").agg(F.collect_list("gram").alias("grams")).collect())   # at most 1 / least_share each
        grams = {r["lang"]: np.array(r["grams"], np.int64).view(np.uint64) for r in common}
        filters.append(LanguageFilters(order, [grams.get(x, np.zeros(0, np.uint64)) for x in languages]))
    return LanguageModel(languages, filters)


def predict_languages(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.
    Ties go to the language first by name. Repeated rows each get a row; a null doc_id
    counts as empty text for the split; an empty table gives no rows."""
    predict = text_udf("lang_pred string, score double", lambda: model.predict)   # the filters' size is bounded
    return (docs.select(F.col(doc_id).alias("doc_id"), (id_remainder(doc_id, SPLIT) == HELD_OUT).alias("held_out"),
                        predict(F.col(text)).alias("p")).select("doc_id", "held_out", "p.*"))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return predict_languages(docs, train_language(docs))
