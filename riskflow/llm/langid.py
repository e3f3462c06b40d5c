"""Language identification by unigram pieces, with all segmentations of a word summed.

The pieces come from a fixed public vocabulary. For each language a probability of each piece is learned by
expectation-maximisation; the probability of a word is the sum over all its segmentations, found by the forward
algorithm, so no segmentation has to be chosen. A text's score for a language is the product over its words. Words are
scored once per slice of texts and kept in a bounded cache over slices.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.llm.common import Batches, byte_class, map_batches, mix, stored, text_bytes, text_slices, word_hashes, word_spans

# Labelled documents to learn from, at most, for each language; they are those of the smallest id hashes.
SAMPLE_PER_LANGUAGE = 1500
EM_ROUNDS = 3
LONGEST_PIECE = 12
# Longer words are scored in parts of so many characters.
LONGEST_WORD = 30
SMOOTHING = 0.1
UNKNOWN = 1e-8
MAX_CACHED = 400_000
# Bytes of text that a task scores at once.
SLICE = 1_000_000
# Ids are counted by no more than this many leading bits of their hashes.
MOST_BITS = 16
UNDETERMINED = "und"

WORD_START = "▁"
# Bytes of words: letters of ASCII, and all that are not ASCII.
LETTERS = byte_class([(0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
_BASE = np.uint64(0x9E3779B97F4A7C15)


def piece_list(vocabulary: str) -> list[str]:
    """The lower-case pieces of letters of a sentencepiece vocabulary, in its order."""
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_byte(i) and not model.is_unknown(i))
    return [p for p in pieces if len(p) <= LONGEST_PIECE and p == p.lower() and p.replace(WORD_START, "", 1).isalpha() or p == WORD_START]


def _code_points(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


class Lattice:
    """Pieces and, for a group of words, which pieces stand where."""

    def __init__(self, pieces: list[str]) -> None:
        keys = np.array([self._hash(p) for p in pieces], np.uint64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.longest = max(map(len, pieces), default=1)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self._slot(self.keys)] = True
        self.n = len(pieces)

    @staticmethod
    def _hash(piece: str) -> int:
        value = 0
        for c in piece:
            value = (value * int(_BASE) + ord(c) + 1) % 2**64
        return value

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (mix(keys) & np.uint64((1 << 20) - 1)).astype(np.int64)

    def edges(self, words: list[str]) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray, np.ndarray]]]:
        """For words of at most LONGEST_WORD characters: their lengths with the start mark, and the pieces in them as
        (end, length, words, pieces), in ascending order of ends. A character without a piece is piece `n`."""
        lengths = np.array([len(w) + 1 for w in words], np.int64)
        width = int(lengths.max())
        chars = np.zeros((len(words), width + self.longest), np.uint64)
        inside = np.arange(width) < lengths[:, None]
        chars[:, :width][inside] = _code_points([WORD_START + w for w in words])
        out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        value = np.zeros((len(words), width), np.uint64)
        for size in range(1, min(self.longest, width) + 1):
            value = value * _BASE + chars[:, size - 1 : size - 1 + width] + np.uint64(1)
            valid = np.arange(width) + size <= lengths[:, None]
            word, start = np.nonzero(valid & self.maybe[self._slot(value)])
            at = np.minimum(np.searchsorted(self.keys, value[word, start]), self.n - 1)
            hit = self.keys[at] == value[word, start]
            word, start, piece = word[hit], start[hit], self.order[at[hit]]
            if size == 1:
                known = np.zeros((len(words), width), bool)
                known[word, start] = True
                w, s = np.nonzero(inside & ~known)
                word, start, piece = np.concatenate([word, w]), np.concatenate([start, s]), np.concatenate([piece, np.full(len(w), self.n)])
            order = np.argsort(start, kind="stable")
            word, start, piece = word[order], start[order], piece[order]
            bounds = np.searchsorted(start, np.arange(width + 1))
            for s in range(width):
                if bounds[s] < bounds[s + 1]:
                    out.append((s + size, size, word[bounds[s] : bounds[s + 1]], piece[bounds[s] : bounds[s + 1]]))
        out.sort(key=lambda e: e[0])
        return lengths, out

    def forward(self, words: list[str], probabilities: np.ndarray) -> np.ndarray:
        """log of the summed probability of each word (row) in each language (column)."""
        out = np.zeros((len(words), probabilities.shape[1]))
        by_length = sorted(range(len(words)), key=lambda i: len(words[i]))
        for low in range(0, len(words), 4096):
            chosen = by_length[low : low + 4096]
            lengths, edges = self.edges([words[i] for i in chosen])
            alpha = np.zeros((int(lengths.max()) + 1, len(chosen), probabilities.shape[1]))
            alpha[0] = 1
            for end, size, word, piece in edges:  # a word is in one edge list at most once
                alpha[end, word] += alpha[end - size, word] * probabilities[piece]
            out[chosen] = np.log(alpha[lengths, np.arange(len(chosen))])
        return out

    def expected(self, words: list[str], counts: np.ndarray, probabilities: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in each language, over words with their counts by language."""
        out = np.zeros_like(probabilities)
        by_length = sorted(range(len(words)), key=lambda i: len(words[i]))
        for low in range(0, len(words), 4096):
            chosen = np.array(by_length[low : low + 4096])
            lengths, edges = self.edges([words[i] for i in chosen])
            shape = (int(lengths.max()) + 1, len(chosen), probabilities.shape[1])
            alpha, beta = np.zeros(shape), np.zeros(shape)
            alpha[0] = 1
            beta[lengths, np.arange(len(chosen))] = 1
            for end, size, word, piece in edges:
                alpha[end, word] += alpha[end - size, word] * probabilities[piece]
            for end, size, word, piece in sorted(edges, key=lambda e: e[1] - e[0]):  # descending starts
                beta[end - size, word] += beta[end, word] * probabilities[piece]
            weight = counts[chosen] / alpha[lengths, np.arange(len(chosen))]
            for end, size, word, piece in edges:
                share = alpha[end - size, word] * probabilities[piece] * beta[end, word] * weight[word]
                for k in range(out.shape[1]):
                    out[:, k] += np.bincount(piece, weights=share[:, k], minlength=len(out))
        return out


@dataclass
class Model:
    pieces: list[str]
    languages: list[str]
    probabilities: np.ndarray  # a row for each piece and one for unknown characters


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32 of the id as text, modulo `folds`, is `fold`; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _parts(word: str) -> list[str]:
    return [word[i : i + LONGEST_WORD] for i in range(0, len(word), LONGEST_WORD)]


def _sample_words(batches: Batches) -> Batches:
    for batch in batches:
        for part in text_slices(batch, "_text", SLICE):
            languages, words = [], []
            data, ends = text_bytes(part.column("_text"))
            starts, stops, first = word_spans(data, ends, LETTERS)
            raw = data.tobytes()
            for lang, a, b in zip(part.column("lang").to_pylist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                found = [p for i in range(a, b) for p in _parts(raw[starts[i] : stops[i]].decode().lower())]
                words += found
                languages += [lang] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(languages, pa.string()), pa.array(words, pa.string())], names=["lang", "word"])


def _expectation(model: Model):
    def expect(batches: Batches) -> Batches:
        lattice = Lattice(model.pieces)
        total = np.zeros_like(model.probabilities)
        for batch in batches:
            lang = np.array([model.languages.index(x) for x in batch.column("lang").to_pylist()], np.int64)
            words = batch.column("word").to_pylist()
            if words:
                counts = np.zeros((len(words), len(model.languages)))
                counts[np.arange(len(words)), lang] = batch.column("n").to_numpy()
                total += lattice.expected(words, counts, model.probabilities)
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], names=["piece", "language", "n"])

    return expect


def smallest_hashes(ids: DataFrame, most: int) -> DataFrame:
    """Of the rows (_id, lang) the `most` of each language with the smallest hashes of _id.

    Rows are counted by language and leading bits of the hash, merged before the shuffle; only rows up to the bits at which
    a language has enough are ranked, so that no task gets all rows of a language.
    """
    ranges = max(1, 4 * ids.count() // max(most, 1))
    shift = 64 - min(ranges.bit_length(), MOST_BITS)
    rows = ids.withColumn("_hash", F.xxhash64("_id")).withColumn("_bits", F.shiftright("_hash", shift))
    before = Window.partitionBy("lang").orderBy("_bits").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("lang", "_bits").agg(F.count(F.lit(1)).alias("n"))
    cuts = counts.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).filter(F.col("_before") < most)
    cuts = cuts.groupBy("lang").agg(F.max("_bits").alias("_cut"))
    near = rows.join(cuts, "lang").filter(F.col("_bits") <= F.col("_cut"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_hash", "_id"))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= most).select("_id", "lang")


def fit(
    docs: DataFrame,
    vocabulary: str,
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    rounds: int = EM_ROUNDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> Model:
    """Learn from labelled rows: at most `sample_per_language` of each non-null language, chosen by a hash of the id.

    What comes to the driver is one number for each piece and language.
    """
    labelled = docs.filter(F.col(lang_column).isNotNull() & F.col(id_column).isNotNull())
    ids = labelled.select(F.col(id_column).alias("_id"), F.col(lang_column).alias("lang"))
    chosen = smallest_hashes(ids, sample_per_language).select("_id").distinct()
    rows = labelled.select(F.col(id_column).alias("_id"), F.col(lang_column).alias("lang"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    texts = rows.join(F.broadcast(stored(chosen, "sample")), "_id").select("lang", "_text")  # the sample bounds it
    counted = map_batches(texts, _sample_words, "lang string, word string").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    words = stored(counted, "words")
    languages = sorted(r["lang"] for r in words.select("lang").distinct().toLocalIterator())
    pieces = piece_list(vocabulary)
    model = Model(pieces, languages, np.full((len(pieces) + 1, max(len(languages), 1)), 1 / len(pieces)))
    model.probabilities[-1] = UNKNOWN
    for _ in range(rounds if languages else 0):
        sums = map_batches(words, _expectation(model), "piece long, language long, n double").groupBy("piece", "language").agg(F.sum("n").alias("n"))
        counts = np.full((len(pieces) + 1, len(languages)), SMOOTHING)
        for row in sums.toLocalIterator():
            counts[row["piece"], row["language"]] += row["n"]
        probabilities = counts / counts[:-1].sum(axis=0)
        probabilities[-1] = UNKNOWN
        model = Model(pieces, languages, probabilities)
    return model


class Scorer:
    """Scores slices of texts; keeps the scores of words."""

    def __init__(self, model: Model) -> None:
        self.model, self.lattice = model, Lattice(model.pieces)
        self.known: dict[int, int] = {}
        self.scores = np.zeros((1 << 14, len(model.languages)))

    def words(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """For each word its row in `scores`."""
        hashes = pa.array(word_hashes(data, starts, stops, LETTERS)).dictionary_encode()
        distinct, index = hashes.dictionary.to_pylist(), hashes.indices.to_numpy()
        if len(self.known) + len(distinct) > MAX_CACHED:
            self.known.clear()
        example = np.zeros(len(distinct), np.int64)
        example[index[::-1]] = np.arange(len(index))[::-1]
        new = [k for k, h in enumerate(distinct) if h not in self.known]
        raw = data.tobytes()
        texts = [raw[a:b].decode().lower() for a, b in zip(starts[example[new]].tolist(), stops[example[new]].tolist(), strict=True)]
        parts = [_parts(t) for t in texts]
        need = len(self.known) + len(new)
        if need > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros((max(need, 2 * len(self.scores)) - len(self.scores), self.scores.shape[1]))])
        if new:
            logs = self.lattice.forward([p for w in parts for p in w], self.model.probabilities)
            begin = np.cumsum([0, *map(len, parts)])[:-1]
            at = len(self.known)
            self.scores[at : at + len(new)] = np.add.reduceat(logs, begin, axis=0)
            self.known.update(zip((distinct[k] for k in new), range(at, at + len(new)), strict=True))
        return np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[index]

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        data, ends = text_bytes(texts)
        starts, stops, first = word_spans(data, ends, LETTERS)
        n, languages = len(texts), self.model.languages
        if not languages or not len(starts):
            return [UNDETERMINED] * n, np.zeros(n)
        index = self.words(data, starts, stops)
        rows = self.scores[index]
        sums = np.concatenate([np.zeros((1, len(languages))), np.cumsum(rows, axis=0)])[first]
        logs = np.diff(sums, axis=0)
        shares = np.exp(logs - logs.max(axis=1, keepdims=True))
        shares /= shares.sum(axis=1, keepdims=True)
        best = shares.argmax(axis=1)
        none = np.diff(first) == 0
        # Texts without a letter of ASCII: are there letters at all?
        letters = np.concatenate([[0], np.cumsum(LETTERS[data] & (data < 0x80))])[ends]
        for i in np.flatnonzero((np.diff(letters) == 0) & ~none).tolist():
            none[i] = not any(c.isalpha() for c in texts[i].as_py())
        predicted = [UNDETERMINED if no else languages[k] for k, no in zip(best.tolist(), none.tolist(), strict=True)]
        return predicted, np.where(none, 0.0, shares[np.arange(n), best])


def predict(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """`docs` with lang_pred and score, the share of the predicted language among all.

    A text that is null or has no letter gets `und` and the score 0, and so does every text if nothing could be learned.
    Ties go to the first language by name. Columns of these names are replaced.
    """
    base = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number for each piece and language

    def run(batches: Batches) -> Batches:
        scorer = Scorer(shared.value)
        for batch in batches:
            for part in text_slices(batch, text_column, SLICE):
                predicted, score = scorer.predict(part.column(text_column))
                columns = [*part.columns, pa.array(predicted, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "lang_pred", "score"])

    schema = base.withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    return map_batches(base, run, schema)
