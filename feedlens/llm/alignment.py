"""Cross-tokenizer alignment by interval coalescing.

Two tokenizers cut the same bytes. All tokens of both sides are sorted by where they
start; a running maximum of their ends is kept, and a new group begins where a token
starts at or beyond it. Inside a group every A token overlaps the group that every B
token shares, so the links of a group are its A tokens times its B tokens.

Groups cross neither texts nor the blanks that both tokenizers cut at, so many words are
aligned as one array and, since words repeat, a word's groups are kept. A document gives each distinct pair of ids once, with how often it is linked there; a pair's count is
the number of documents that give it. Those counts return to the documents by a join, for
which the counts are broadcast if there are at most ``BROADCAST_PAIRS``.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from tokenizers import Tokenizer

from feedlens.llm.common import CHUNK_CHARS, chunks, materialise, read_table, worker_state

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SLICE = 1 << 20      # links or pairs that are spelled out at a time
BROADCAST_PAIRS = 1 << 20    # id pairs with their counts: about 60 MB in memory
KEPT_WORDS, KEPT_CHARS = 400_000, 1 << 25
# Texts without other characters than these (below U+0250, but for the controls that engines
# disagree on) are cut into words: a space and all up to the next space that follows no
# white space, where both tokenizers cut.
_OTHER = re.compile("[^\\x00-\\x1b\\x20-\\x84\\x86-\u024f]").search
_WORDS = re.compile(r" \s*+(?:\S++(?:[^\S ]\s*+)?+)*+").findall
_EDGE = re.compile(r"(?<=\S) ").search

_PAIRS = "array<struct<pair:long,times:long>>"
_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def byte_level_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte: itself for
    the visible Latin-1 characters, the next free one from U+0100 for the others."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table = {chr(b): b for b in visible}
    for k, b in enumerate(sorted(set(range(256)) - set(visible))):
        table[chr(256 + k)] = b
    return table


class Side:
    """One tokenizer: ``encode`` takes texts with the space before them; per id its bytes, their
    number and its decimal text with each of the separators that may follow. ``cuts``:
    whether it encodes the words of ``_WORDS`` one by one, whatever stands beside them;
    ``joins``: whether it is faster to encode many as one text."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], pieces: list[bytes], cuts: bool, joins: bool = False):
        self.encode, self.pieces, self.cuts, self.joins = encode, pieces, cuts, joins
        self.sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.names = np.array([[f"{k}{end}" for k in range(len(pieces))] for end in ("", ",", "|", ";")], dtype=object)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, how many each has, and whether its bytes are the text's."""
        want = np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts), np.int64, len(texts))
        piece, whole = self.pieces.__getitem__, "".join(texts)
        if self.joins and self.cuts and not any(t[-1:].isspace() for t in texts):     # then they are words of one text, too
            flat = np.array(self.encode([whole])[0] if texts else [], np.int64)
            ends, edges = np.cumsum(self.sizes[flat]), np.cumsum(want)
            last = np.searchsorted(ends, edges)
            if len(flat) and ends[-1] == edges[-1] and (ends[last] == edges).all() and b"".join(map(piece, flat.tolist())) == whole.encode():
                return flat, np.diff(last, prepend=-1), np.ones(len(texts), bool)
        found = self.encode(texts)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum()))
        return flat, counts, np.array([b"".join(map(piece, ids)) == t.encode() for t, ids in zip(texts, found)], bool)


def byte_level_side(path: str) -> Side:
    """A byte-level BPE file, whose pre-tokenizer cuts before the space after another sign; the
    strings of special tokens are plain text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # Spark's tasks share the cores
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    alphabet, vocabulary = byte_level_alphabet(), tokenizer.get_vocab()
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for token, k in vocabulary.items():
        pieces[k] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return Side(encode, pieces, cuts=True, joins=True)


def piece_side(path: str) -> Side:
    """A sentence piece model, which adds the space before a text itself. Where no piece has a
    space after another character, it cuts before each run of spaces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        pieces.append(bytes([int(piece[3:5], 16)]) if model.is_byte(k) else piece.replace("▁", " ").encode())
    lead = len(model.encode("a"))

    def encode(texts: list[str]) -> list[list[int]]:
        """The texts start with the space that the model adds; one of nothing else needs a word before it."""
        found = model.encode([t[1:] if t.strip(" ") else "a" + t for t in texts], num_threads=1)
        return [ids if t.strip(" ") else ids[lead:] for t, ids in zip(texts, found)]

    return Side(encode, pieces, not any(b" " in p.lstrip(b" ") for p in pieces))


def side(name: str) -> Side:
    """The worker's tokenizer for a file, kept from task to task."""
    kept, path = worker_state(), public_tokenizers.path(name)
    if path not in kept:
        kept[path] = piece_side(path) if name.endswith(".model") else byte_level_side(path)
    return kept[path]


def coalesce(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The group (from 0) of each interval; the intervals are sorted by start. A group
    begins where a start reaches the running maximum of all ends before."""
    if not len(starts):
        return np.zeros(0, np.int64)
    reach = np.maximum.accumulate(ends)
    return np.concatenate(([0], np.cumsum(starts[1:] >= reach[:-1])))


def _spans(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starts and ends of the ids' bytes, laid end to end."""
    ends = np.cumsum(sizes[ids])
    return ends - sizes[ids], ends


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins, and the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate((np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))), [len(keys)]))


def _distinct(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each group's distinct ids in turn, with how often they stand in it."""
    order = np.lexsort((ids, group))
    key = group[order] * (1 << 32) + ids[order]
    edges = _runs(key)
    return key[edges[:-1]] >> 32, key[edges[:-1]] & 0xFFFFFFFF, np.diff(edges)


def linked_pairs(group_a: np.ndarray, a: np.ndarray, group_b: np.ndarray, b: np.ndarray, n_groups: int) -> Iterator[tuple]:
    """(group, pair, times) arrays of all linked pairs of ids, pair = A id * 2**32 + B id,
    about ``SLICE`` at a time. Within a group each pair of ids comes once."""
    ga, ia, na = _distinct(group_a, a)
    gb, ib, nb = _distinct(group_b, b)
    of_b = np.bincount(gb, minlength=n_groups)
    first_b = np.cumsum(of_b) - of_b
    todo = of_b[ga]                       # pairs that start from each A id
    done = np.concatenate(([0], np.cumsum(todo)))
    begin = 0
    while begin < len(ga):
        end = max(begin + 1, int(np.searchsorted(done, done[begin] + SLICE, side="right")) - 1)
        k = np.repeat(np.arange(begin, end), todo[begin:end])
        at = np.arange(len(k)) - (done[k] - done[begin]) + first_b[ga[k]]
        yield ga[k], (ia[k] << 32) | ib[at], na[k] * nb[at]
        begin = end


def _summed(row: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, pair) with their times added up."""
    order = np.lexsort((pair, row))
    row, pair, times = row[order], pair[order], times[order]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (pair[1:] != pair[:-1])))
    at = np.flatnonzero(new)
    return row[at], pair[at], np.add.reduceat(times, at)


class Pairs:
    """Distinct pairs of some texts. Slices are merged as they come, so memory follows the
    distinct pairs and not the links."""

    def __init__(self):
        empty = np.zeros(0, np.int64)
        self.found, self.waiting, self.rows = (empty, empty, empty), [], 0

    def add(self, row, pair, times) -> None:
        self.waiting.append((row, pair, times))
        self.rows += len(row)
        if self.rows > max(2 * SLICE, len(self.found[0])):
            self.merge()

    def merge(self) -> tuple:
        if self.waiting:
            parts = [self.found, *self.waiting]
            self.found, self.waiting, self.rows = _summed(*(np.concatenate(c) for c in zip(*parts))), [], 0
        return self.found


def align_words(words: list[str], left: Side, right: Side, with_groups: bool = True) -> tuple[np.ndarray, np.ndarray, list[str], tuple]:
    """Words or whole texts, each with the space before it, aligned by themselves: whether both
    sides keep its bytes, figures n_a, n_b, n_groups, n_links, its groups as text
    (``a1,a2|b1;a3|b2,b3``), and (word, pair, times) of the distinct linked pairs of ids."""
    (ids_a, n_a, keeps_a), (ids_b, n_b, keeps_b) = (s.ids(words) for s in (left, right))
    kept = keeps_a & keeps_b
    if not kept.all():
        ids_a, ids_b = ids_a[np.repeat(kept, n_a)], ids_b[np.repeat(kept, n_b)]
        n_a, n_b = n_a * kept, n_b * kept
    figures = np.zeros((len(words), 4), np.int64)
    figures[:, 0], figures[:, 1] = n_a, n_b
    (starts_a, ends_a), (starts_b, ends_b) = _spans(ids_a, left.sizes), _spans(ids_b, right.sizes)
    pairs = Pairs()
    if not len(ids_a):
        return kept, figures, [""] * len(words), pairs.merge()
    on_b = np.repeat([False, True], [len(ids_a), len(ids_b)])
    starts, ends, ids = (np.concatenate(c) for c in ((starts_a, starts_b), (ends_a, ends_b), (ids_a, ids_b)))
    order = np.lexsort((on_b, starts))
    group = np.empty(len(order), np.int64)
    group[order] = coalesce(starts[order], ends[order])
    group_a, group_b = group[:len(ids_a)], group[len(ids_a):]
    n_groups = int(group[order[-1]]) + 1
    word_of = np.empty(n_groups, np.int64)
    word_of[group_a] = np.repeat(np.arange(len(words)), figures[:, 0])
    word_of[group_b] = np.repeat(np.arange(len(words)), figures[:, 1])
    in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    figures[:, 2] = np.bincount(word_of, minlength=len(words))
    np.add.at(figures[:, 3], word_of, in_a * in_b)
    one = (in_a == 1) & (in_b == 1)         # most groups are one token on either side
    first_a, first_b = one[group_a], one[group_b]
    pairs.add(word_of[one], (ids_a[first_a] << 32) | ids_b[first_b], np.ones(int(one.sum()), np.int64))
    for g, pair, times in linked_pairs(group_a[~first_a], ids_a[~first_a], group_b[~first_b], ids_b[~first_b], n_groups):
        pairs.add(word_of[g], pair, times)
    spelled = _spelled(group, on_b, ids, left, right, word_of, len(words)) if with_groups else [""] * len(words)
    return kept, figures, spelled, pairs.merge()


class Words:
    """Alignments of words by number, in the order in which they were met."""

    def __init__(self, left: Side, right: Side, with_groups: bool):
        self.left, self.right, self.with_groups = left, right, with_groups
        self.number: dict[str, int] = {}
        self.chars = 0
        self.kept, self.figures, self.groups = np.zeros(0, bool), np.zeros((0, 4), np.int64), []
        self.first, self.pair, self.times = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the third that was met first: the common words (none where words are very long)."""
        n = KEPT_WORDS // 3 if self.chars <= KEPT_CHARS else 0
        self.number = dict(islice(self.number.items(), n))
        self.kept, self.figures, self.groups = self.kept[:n], self.figures[:n], self.groups[:n]
        self.first = self.first[:n + 1]
        self.pair, self.times = self.pair[:self.first[-1]], self.times[:self.first[-1]]
        self.chars = sum(map(len, self.number))

    def _learn(self, words: list[str]) -> None:
        kept, figures, groups, (of, pair, times) = align_words(words, self.left, self.right, self.with_groups)
        self.number.update(zip(words, range(len(self.groups), len(self.groups) + len(words))))
        self.kept, self.figures = np.concatenate((self.kept, kept)), np.concatenate((self.figures, figures))
        self.groups += groups
        self.chars += sum(map(len, words))
        more = np.cumsum(np.bincount(of, minlength=len(words)))
        self.first = np.concatenate((self.first, self.first[-1] + more))
        self.pair, self.times = np.concatenate((self.pair, pair)), np.concatenate((self.times, times))

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self.groups) > KEPT_WORDS or self.chars > KEPT_CHARS:
            self._forget()
        found = list(map(self.number.get, words))
        fresh = [k for k, x in enumerate(found) if x is None]
        if fresh:
            self._learn(list(dict.fromkeys(words[k] for k in fresh)))
            for k in fresh:
                found[k] = self.number[words[k]]
        return np.array(found, np.int64)

    def pairs_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``numbers``, pair, times) of the words' pairs."""
        many = self.first[numbers + 1] - self.first[numbers]
        at = np.repeat(self.first[numbers] - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.repeat(np.arange(len(numbers)), many), self.pair[at], self.times[at]


def _parts(text: str) -> Iterator[str]:
    """A text with a space before it, in parts of about ``CHUNK_CHARS`` that end between words."""
    whole, at = " " + text, 0
    while len(whole) - at > CHUNK_CHARS:
        edge = _EDGE(whole, at + CHUNK_CHARS)
        if not edge:
            break
        yield whole[at:edge.start()]
        at = edge.start()
    yield whole[at:]


def align(texts: list[str], words: Words) -> tuple[np.ndarray, list[str], tuple]:
    """Figures n_a, n_b, n_groups, n_links of each text, its groups as text, and (text, pair,
    times) of the distinct linked pairs of ids. Texts without tokens have zeros and ''."""
    figures, groups, pairs = np.zeros((len(texts), 4), np.int64), [[] for _ in texts], Pairs()
    lost = np.zeros(len(texts), bool)
    by_words = words.left.cuts and words.right.cuts
    plain = [bool(t) and by_words and not _OTHER(t) for t in texts]
    parts = [(k, part) for k, t in enumerate(texts) if plain[k] for part in _parts(t)]
    for x, y in chunks([len(part) for _, part in parts]):
        split = [_WORDS(part) for _, part in parts[x:y]]
        numbers, sizes = words.numbers(list(chain.from_iterable(split))), np.array([len(s) for s in split], np.int64)
        of = np.repeat(np.array([k for k, _ in parts[x:y]], np.int64), sizes)
        lost[of[~words.kept[numbers]]] = True
        np.add.at(figures, of, words.figures[numbers])
        if words.with_groups:
            said = list(map(words.groups.__getitem__, numbers.tolist()))
            for (k, _), a, n in zip(parts[x:y], (np.cumsum(sizes) - sizes).tolist(), sizes.tolist()):
                groups[k].append(";".join(said[a:a + n]))
        for a in range(0, len(numbers), SLICE):
            place, pair, times = words.pairs_of(numbers[a:a + SLICE])
            pairs.add(of[a:a + SLICE][place], pair, times)
    whole = [k for k, t in enumerate(texts) if t and not plain[k]]
    if whole:
        kept, own, said, (of, pair, times) = align_words([" " + texts[k] for k in whole], words.left, words.right, words.with_groups)
        number = np.array(whole, np.int64)
        figures[number], lost[number] = own, ~kept
        for k, s in zip(whole, said):
            groups[k].append(s)
        pairs.add(number[of], pair, times)
    of, pair, times = pairs.merge()
    if lost.any():       # a word that one side does not keep: the text has no tokens
        figures[lost] = 0
        here = ~lost[of]
        of, pair, times = of[here], pair[here], times[here]
    return figures, ["" if gone else ";".join(g) for g, gone in zip(groups, lost.tolist())], (of, pair, times)


def _spelled(group, on_b, ids, left: Side, right: Side, text_of, n_texts) -> list[str]:
    """Each text's groups as text. Tokens of a side stand in order, so a stable sort by
    (group, side) leaves them so."""
    order = np.lexsort((on_b, group))
    g, s, k = group[order], on_b[order], ids[order]
    after = np.zeros(len(k), np.int64)   # what follows a token: nothing, comma, bar, semicolon
    after[:-1] = np.where(g[1:] != g[:-1], 3, np.where(s[1:] != s[:-1], 2, 1))
    of = text_of[g]
    after[:-1][of[1:] != of[:-1]] = 0
    names = np.empty(len(k), dtype=object)
    names[~s], names[s] = left.names[after[~s], k[~s]], right.names[after[s], k[s]]
    edges = np.searchsorted(of, np.arange(n_texts + 1))
    return ["".join(names[x:y].tolist()) for x, y in zip(edges, edges[1:])]


def _aligned(a: str, b: str, with_groups: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, key = worker_state(), f"words of {a} and {b}, {with_groups}"
        words = kept.setdefault(key, Words(side(a), side(b), with_groups))
        for batch in batches:
            keys, texts = batch.columns[:2], batch.column(2)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for x, y in chunks(sizes):
                figures, groups, (of, pair, times) = align([t or "" for t in texts.slice(x, y - x).to_pylist()], words)
                here = [c.slice(x, y - x) for c in keys]
                edges = np.searchsorted(of, np.arange(y - x + 1))
                yield _batch(here, figures, groups, edges, pair, times)
                # a text of more than SLICE pairs: the others follow in rows of their own
                for k in np.flatnonzero(np.diff(edges) > SLICE).tolist():
                    for p in range(edges[k] + SLICE, edges[k + 1], SLICE):
                        part = np.array([p, min(p + SLICE, edges[k + 1])])
                        yield _batch([c.slice(k, 1) for c in here], None, None, part, pair, times)

    return work


def _batch(keys: list[pa.Array], figures, groups, edges, pair, times) -> pa.RecordBatch:
    """Rows of ``_aligned``: row k holds the first ``SLICE`` of the pairs edges[k] to edges[k + 1]."""
    n = len(edges) - 1
    spans = [(x, min(y, x + SLICE)) for x, y in zip(edges.tolist(), edges[1:].tolist())]
    inside = np.concatenate([np.arange(x, y) for x, y in spans])
    offsets = pa.array(np.concatenate(([0], np.cumsum([y - x for x, y in spans]))), pa.int32())
    items = pa.StructArray.from_arrays([pa.array(pair[inside]), pa.array(times[inside])], ["pair", "times"])
    columns = [pa.nulls(n, pa.int64())] * 4 if figures is None else [pa.array(figures[:, k]) for k in range(4)]
    spelled = pa.nulls(n, pa.string()) if groups is None else pa.array(groups, pa.string())
    return pa.RecordBatch.from_arrays([*keys, *columns, spelled, pa.ListArray.from_arrays(offsets, items)],
                                      names=["__row", "__id", *_FIGURES, "groups", "__pairs"])


def token_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a: str = TOKENIZER_A, b: str = TOKENIZER_B,
                 with_groups: bool = True) -> DataFrame:
    """For each row of ``docs``, numbered in ``__row`` and with its id in ``__id``: n_a, n_b,
    n_groups, n_links, groups (``a1,a2|b1;...``, '' without tokens or if not asked for) and
    the distinct linked pairs of ids in ``__pairs``. A text of over ``SLICE`` distinct pairs
    has further rows, in which the figures are null, so no cell grows without bound."""
    given = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(doc_id).alias("__id"), F.col(text).cast("string").alias("__text"))
    id_type = given.schema["__id"].dataType.simpleString()
    figures = ", ".join(f"{c} long" for c in _FIGURES)
    return given.mapInArrow(_aligned(a, b, with_groups), f"__row long, __id {id_type}, {figures}, groups string, __pairs {_PAIRS}")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """pair, n_documents and ``best`` (whether the count is the highest of its A id) from
    rows (``__row``, pair) that hold each pair of a document once."""
    counts = pairs.groupBy("pair").agg(F.count("*").alias("n_documents"))
    per_a = W.partitionBy(F.shiftright("pair", 32))     # at most as many rows as B has ids
    return counts.withColumn("best", F.col("n_documents") == F.max("n_documents").over(per_a))


def align_tokenizers(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a: str = TOKENIZER_A, b: str = TOKENIZER_B,
                     keep_groups: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, and the groups as text if asked for.

    Null and empty texts, and texts whose tokens don't give back their bytes (a normalising
    or lossy model), have no tokens: zeros and ''. Repeated rows count as documents of their
    own, null ids too; an empty table gives no rows; other columns are dropped. The written
    intermediate holds a text's distinct pairs, never its links."""
    made = token_groups(docs, doc_id, text, a, b)
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    kept = ["groups"] if keep_groups else []
    made = materialise(made.select("__row", "__id", *_FIGURES, digest.alias("groups_sha256"), *kept, "__pairs"),
                       "aligned")
    pairs = made.select("__row", F.explode("__pairs").alias("__p")).select("__row", "__p.pair", "__p.times")
    counts = materialise(pair_counts(pairs), "pair_counts")
    if counts.count() <= BROADCAST_PAIRS:
        counts = F.broadcast(counts)
    sums = (pairs.join(counts, "pair").groupBy("__row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                 F.sum(F.col("times") * F.col("n_documents")).alias("count_sum")))
    figures = made.filter(F.col("n_a").isNotNull()).drop("__pairs")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return figures.join(sums, "__row", "left").select(F.col("__id").alias("doc_id"), *_FIGURES, *zero, "groups_sha256", *kept)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(read_table(spark, sf_dir, "documents"))
