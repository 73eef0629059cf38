"""Language identification by segmentation-marginalised unigrams.

A model has, for every language, a probability of each piece of a fixed public
vocabulary (the tokenizer is only read, never trained).  A word's probability
is the sum over all ways to cut it into pieces, by the forward algorithm; a
text's score is the product over its words.  The pieces' probabilities are
counted on a bounded sample of labelled texts per language.

Words are maximal runs of letters, lower-cased.  A batch's distinct words are
scored once, with the forward algorithm run over all words of one length at
the same time.

Defined results: null text or text without letters gives ``und`` and score 0;
without any labelled text every text is ``und``; ties go to the first language
by code point; runs of letters longer than ``MAX_WORD`` are scored in parts; a
null doc_id is not held out and takes no part in learning; an empty table
gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.arrowtext import mix64
from sparkmart.llm.common import stored

#: Fixed public vocabulary.
VOCABULARY = "piece_bpe_32k.model"
#: Bound of the learning sample: texts per language.
TRAIN_TEXTS = 600
#: Added to every piece count; probability of a character outside the vocabulary.
SMOOTHING = 0.1
UNKNOWN = 1e-7
#: Letters per scored part of a word, characters per batch.
MAX_WORD = 32
BATCH_CHARS = 1 << 21
UND = "und"

_MARK = "▁"  # stands before a word in the vocabulary
_ODD = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """Documents whose crc32 of the id's text is 2 modulo 4 are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


_LETTERS: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Per code point: 1 for a mark, 2 for a letter, else 0."""
    if not _LETTERS:
        import regex

        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        points = np.frombuffer(every.encode("utf-32-le"), np.uint32)
        table = np.zeros(0x110000, np.uint8)
        for pattern, kind in ((r"\p{M}+", 1), (r"\p{L}+", 2)):
            for m in regex.finditer(pattern, every):
                table[points[m.start() : m.end()]] = kind
        _LETTERS.append(table)
    return _LETTERS[0]


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    base = np.full(n, pow(int(_ODD), -1, 1 << 64) if inverse else int(_ODD), np.uint64)
    base[:1] = 1
    return np.multiply.accumulate(base)


def _values(cp: np.ndarray) -> np.ndarray:
    return mix64(cp.astype(np.uint64) + np.uint64(1))


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code points, start, end, words per text) of the lower-cased letter runs, long runs in parts."""
    low = [t.lower() for t in texts]
    cp = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, low), np.int64, len(low)))])
    inside = np.zeros(len(cp) + 1, np.bool_)
    kind = _letter_table()[cp]
    inside[:-1] = kind > 0
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    heads = offsets[:-1][offsets[:-1] < len(cp)]
    first[heads] = inside[heads]
    last = inside[:-1] & ~inside[1:]
    ends_of_text = offsets[1:][offsets[1:] > 0] - 1
    last[ends_of_text] = inside[ends_of_text]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    letters = np.concatenate([[0], np.cumsum(kind == 2)])
    real = letters[end] > letters[start]  # marks alone are no word
    start, end = start[real], end[real]
    parts = -(-(end - start) // MAX_WORD)
    if len(parts) and parts.max() > 1:
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, end = np.repeat(start, parts) + k * MAX_WORD, np.minimum(np.repeat(end, parts), np.repeat(start, parts) + (k + 1) * MAX_WORD)
    per_text = np.diff(np.searchsorted(start, offsets))
    return cp, start, end, per_text


def _word_hashes(cp, start, end) -> np.ndarray:
    run = np.zeros(len(cp) + 1, np.uint64)
    np.cumsum((cp.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03) * _powers(len(cp)), out=run[1:])
    return mix64((run[end] - run[start]) * _powers(len(cp) + 1, True)[start] + (end - start).astype(np.uint64))


class PieceTable:
    """Open-addressing hash table from a piece's hash to its row of probabilities."""

    def __init__(self, pieces: list[str], prob: np.ndarray):
        keys = np.array([self.key(p) for p in pieces], np.uint64)
        self.longest = max(map(len, pieces), default=1)
        self.bits = max(4, int(2 * len(keys)).bit_length() + 1)
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.rows = np.full(1 << self.bits, len(pieces), np.int32)
        self.probes = 1
        mask = (1 << self.bits) - 1
        for i, k in enumerate(keys.tolist()):
            at, step = k >> (64 - self.bits), 1
            while self.rows[at] != len(pieces):
                at, step = (at + 1) & mask, step + 1
            self.keys[at], self.rows[at] = k, i
            self.probes = max(self.probes, step)
        self.prob = np.vstack([prob, np.zeros((1, prob.shape[1]))])

    @staticmethod
    def key(piece: str) -> int:
        cp = np.array([ord(c) for c in piece], np.uint64)
        with np.errstate(over="ignore"):
            return int(mix64(np.array([(_values(cp) * _powers(len(cp))).sum(dtype=np.uint64)]))[0])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash; the last row (all zero) when it is no piece."""
        none = len(self.prob) - 1
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        row = np.where(self.keys[at] == hashes, self.rows[at], none)
        open_ = np.flatnonzero((row == none) & (self.rows[at] != none))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            slot = at[open_]
            hit = self.keys[slot] == hashes[open_]
            row[open_[hit]] = self.rows[slot[hit]]
            open_ = open_[~hit & (self.rows[slot] != none)]
        return row


def score_words(cp, start, end, table: PieceTable) -> np.ndarray:
    """Log probability of each word in each language, summed over all its segmentations."""
    out = np.zeros((len(start), table.prob.shape[1]))
    length = end - start
    for n in np.unique(length).tolist():
        rows = np.flatnonzero(length == n)
        for part in np.array_split(rows, max(1, len(rows) * (n + 1) // 400_000)):
            m = len(part)
            letters = np.empty((m, n + 1), np.uint32)
            letters[:, 0] = ord(_MARK)
            letters[:, 1:] = cp[start[part][:, None] + np.arange(n)]
            run = np.zeros((m, n + 2), np.uint64)
            np.cumsum(_values(letters) * _powers(n + 1), axis=1, out=run[:, 1:])
            back = _powers(n + 2, True)
            forward = np.zeros((n + 2, m, table.prob.shape[1]))
            forward[0] = 1.0
            for i in range(1, n + 2):
                for k in range(1, min(i, table.longest) + 1):
                    row = table.find(mix64((run[:, i] - run[:, i - k]) * back[i - k]))
                    if k == 1:
                        p = table.prob[row]
                        p[row == len(table.prob) - 1] = UNKNOWN
                        forward[i] += forward[i - 1] * p
                    else:
                        hit = np.flatnonzero(row != len(table.prob) - 1)
                        if len(hit):
                            forward[i, hit] += forward[i - k, hit] * table.prob[row[hit]]
            out[part] = np.log(np.maximum(forward[n + 1], 1e-300))
    return out


def _groups(columns, limit: int):
    """Slices of aligned Python lists whose last list (texts) has at most ``limit`` characters, or one longer text."""
    at, size = 0, 0
    texts = columns[-1]
    for i, t in enumerate(texts):
        if i > at and size + len(t) > limit:
            yield [c[at:i] for c in columns]
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield [c[at:] for c in columns]


def _vocabulary() -> list[str]:
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(VOCABULARY))
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return [p for p in pieces if p and all(c.isalpha() or c == _MARK for c in p)]


def learn(docs: DataFrame, train_texts: int = TRAIN_TEXTS, smoothing: float = SMOOTHING) -> tuple[list[str], list[str], np.ndarray]:
    """(languages, pieces, probabilities) from (text, lang) of documents that are not held out.

    At most about ``train_texts`` texts per language, chosen by a hash of the
    id, are segmented by the vocabulary's own tokenizer and their pieces counted.
    """
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    languages, pieces = sorted(sizes), _vocabulary()
    if not languages:
        return [], pieces, np.zeros((len(pieces), 0))
    spark = docs.sparkSession
    rates = spark.createDataFrame([(k, min(1.0, train_texts / n)) for k, n in sizes.items()], "__lang string, __rate double")
    draw = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.join(F.broadcast(rates), F.col("lang") == F.col("__lang")).where(draw < F.col("__rate")).select("lang", "text")

    def count(batches):
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(VOCABULARY))
        for batch in batches:
            for langs, texts in _groups([batch.column(0).to_pylist(), batch.column(1).to_pylist()], BATCH_CHARS):
                for lang in sorted(set(langs)):
                    cp, start, end, _ = words([t for lg, t in zip(langs, texts, strict=True) if lg == lang])
                    if not len(start):
                        continue
                    letters = cp.astype("<u4").tobytes()
                    run = [letters[4 * a : 4 * b].decode("utf-32-le") for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                    ids = np.array([i for w in sp.encode(run, num_threads=1) for i in w], np.int64)
                    seen, n = np.unique(ids, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(seen)), pa.array([sp.id_to_piece(int(i)) for i in seen]), pa.array(n)], ["lang", "piece", "n"]
                    )

    counts = sample.mapInArrow(count, "lang string, piece string, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    column = {k: i for i, k in enumerate(languages)}
    place = {p: i for i, p in enumerate(pieces)}
    total = np.zeros((len(pieces), len(languages)))
    for r in counts.collect():  # at most languages x vocabulary rows
        if r["piece"] in place:
            total[place[r["piece"]], column[r["lang"]]] += r["n"]
    total += smoothing
    return languages, pieces, total / total.sum(axis=0)


def predict(docs: DataFrame, model) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (posterior of the predicted language, equal priors)."""
    languages, pieces, prob = model
    shared = docs.sparkSession.sparkContext.broadcast((languages, pieces, prob.astype(np.float64)))
    held: list = []

    def run(batches):
        names, vocabulary, p = shared.value
        if not held:
            held.append(PieceTable(vocabulary, p) if names else None)
        table = held[0]
        for batch in batches:
            ids, outs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for group_ids, group_out, group in _groups([ids, outs, texts], BATCH_CHARS):
                label, score = [UND] * len(group), np.zeros(len(group))
                cp, start, end, per_text = words(group)
                if names and len(start):
                    _, at, back = np.unique(_word_hashes(cp, start, end), return_index=True, return_inverse=True)
                    logs = score_words(cp, start[at], end[at], table)[back]
                    some = np.flatnonzero(per_text)
                    stops = np.cumsum(per_text)
                    total = np.add.reduceat(logs, (stops - per_text)[some], axis=0)
                    best = total.argmax(axis=1)
                    post = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                    for i, b, s in zip(some.tolist(), best.tolist(), post.tolist(), strict=True):
                        label[i], score[i] = names[b], s
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group_ids, pa.int64()), pa.array(group_out, pa.bool_()), pa.array(label), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, train_texts: int = TRAIN_TEXTS) -> DataFrame:
    """Learn from the documents that are not held out, predict all of them."""
    return predict(docs, learn(docs.select("doc_id", "text", "lang"), train_texts))
