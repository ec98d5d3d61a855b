"""Scores of abusive, hateful or sexual language.

Class-conditional Kneser-Ney models: a trigram model of toxic and one of ordinary sentences share their lowest
order, the continuation counts of both, so that rare expressions are smoothed alike. A sentence's score is the
difference of its two log-likelihoods, each normalised by its length; a document's score is that of its
highest sentence; a document is a case at or above a cutoff set by cross-validation on the labels. No single
word can add more to a sum than a bound, so that a rare word in a wrongly labelled document doesn't decide.

Labels are given per document, mostly of ordinary sentences, and some are wrong. So the toxic model is first
fitted to all sentences of the documents labelled so, and then, again and again, to each by the probability
that it is a toxic one (expectation maximisation); each is judged by models that haven't seen its document, so that an expression
counts only if other documents bear it out.

Sentences are read across the cues of a subtitle file, in a spelling that undoes common disguises: wrong
encodings, look-alike letters of other scripts, digits and signs for letters, mixed case, spaced-out words,
repeated letters and typical recognition errors.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import stage

#: The models are fitted to at most so many labelled documents, taken by the hash of their id.
MAX_LABELLED = 12_000
#: And to at most so many of their words: documents beyond, in the same order, are left out whole.
MAX_WORDS = 4_000_000
ROUNDS = 3
#: Labelled documents are judged by models fitted without their own fold, of so many.
FOLDS = 4
#: The most that one word can add to, or take from, the sum of a sentence.
WORD_BOUND = 2.0
#: The share of toxic sentences assumed in a document labelled toxic: cautious, so that chance repetitions don't count.
TOXIC_SHARE = 0.01
#: What the cutoff is drawn to where labels are few, and with the weight of how many documents.
USUAL_CUTOFF, USUAL_WEIGHT = 0.3, 3.0
_DISCOUNTS = (0.75, 0.8)
_TINY = 1e-9

#: Letters of other scripts that look like Latin ones (fixed values).
_LOOK_ALIKE = dict(
    zip(
        "аеорсухкмтвніѕјԁԛԝһАЕОРСУХКМТВНІЅЈαοερτυνικβΑΕΟΡΤΥΝΙΚΒΜΗΖΧ",
        "aeopcyxkmtbhisjdqwhAEOPCYXKMTBHISJaoeptuvikbAEOPTYNIKBMHZX",
    )
)
#: Digits and signs read as letters within a word (fixed values).
_SIGNS = {"1": "i", "0": "o", "|": "i", "$": "s", "@": "a", "3": "e", "5": "s", "7": "t", "4": "a", "!": "i", "8": "b", "9": "g"}

_TIMES = re.compile(r"[\[(]?\d+:\d\d|\d+$|WEBVTT|.*-->")
_FRAMES = re.compile(r"\{[^}]*\}|<[^>]*>")
_FOREIGN = re.compile(r"[^\x00-\x7f]+")
_ELLIPSIS = re.compile(r"\.\.+|…")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .\-_*]){3,}[^\W\d_](?![^\W_])")
_BREAKS = re.compile(r"[ .\-_*]")
_TOKEN = re.compile(r"(?:[a-z0-9@$*]|(?<=[a-z0-9])['!](?=[a-z0-9]))+|[.!?]+(?![a-z0-9])|[()\[\]]")
_REPEATED = re.compile(r"(.)\1{2,}")
_CAPITAL = re.compile(r"[^a-zA-Z0-9]*[A-Z]")
_END, _CUE = ".", "^"


@lru_cache(1)
def _plain() -> dict[int, str]:
    """For ``str.translate``: look-alikes as Latin letters, letters without marks, Cyrillic misread for Western text."""
    table = {}
    for point in [*range(0x80, 0x3000), *range(0xFF00, 0xFFF0), *range(0x1D400, 0x1D800)]:
        ch = chr(point)
        if ch not in _LOOK_ALIKE and 0x400 <= point < 0x460:
            try:
                ch = ch.encode("cp1251").decode("latin-1")
            except UnicodeError:
                pass
        plain = _LOOK_ALIKE.get(ch) or "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        plain = plain.replace("ß", "ss").replace("æ", "ae").replace("œ", "oe").replace("ø", "o")
        if unicodedata.category(ch) in ("Cf", "Mn"):
            plain = ""
        if plain != chr(point):
            table[point] = plain
    return table


@lru_cache(50_000)
def _foreign(run: str) -> str:
    """A run of other than ASCII characters, with UTF-8 that was read as another encoding put right, in plain letters."""
    for encoding in ("cp1252", "latin-1", "cp437"):
        try:
            raw = run.encode(encoding, "strict")
        except UnicodeError:
            raw = b"".join(c.encode(encoding) if _fits(c, encoding) else c.encode("latin-1") if ord(c) < 256 else b"\xff" for c in run)
        try:
            return _foreign(raw.decode("utf-8")) if len(raw) > 1 else run.translate(_plain())
        except UnicodeError:
            continue
    return run.translate(_plain())


@lru_cache(5_000)
def _fits(c: str, encoding: str) -> bool:
    try:
        c.encode(encoding)
    except UnicodeError:
        return False
    return True


@lru_cache(200_000)
def _word(w: str) -> str:
    """A word in the one spelling that its disguises and recognition errors share."""
    if w.isdigit():
        return "#"
    if not w.isalpha():
        w = "".join(_SIGNS.get(c, c) for c in w if c not in "*'-_.")
    w = _REPEATED.sub(r"\1", w)
    return w.replace("vv", "w").replace("rn", "m").replace("cl", "d").replace("i", "l").replace("c", "e")


def _line_words(line: str) -> list[str]:
    """The words of a line and the ends of sentences; a capital at its start comes after an end, or ``_CUE`` before that."""
    line = line.strip().replace("|", " ")
    if _TIMES.match(line):
        return []
    bare = _FRAMES.sub(" ", line)
    if not bare.isascii():
        bare = _FOREIGN.sub(lambda m: _foreign(m.group()), _ELLIPSIS.sub(" ", bare))
    starts = _CAPITAL.match(bare) is not None and not bare.isupper()
    bare = _ELLIPSIS.sub(" ", bare.lower())
    if _SPACED.search(bare):
        bare = _SPACED.sub(lambda m: _BREAKS.sub("", m.group()), bare)
    words = [_END if t[0] in ".!?()[]" else _word(t) for t in _TOKEN.findall(bare)]
    return [_END if line[0] == "{" else _CUE, *words] if starts and words else words


def sentences(text: str) -> list[list[str]]:
    """The sentences of a text, each a list of words in their one spelling.

    They end at marks, brackets and where a cue begins with a capital; all else runs on over lines and cues.
    """
    out: list[list[str]] = [[]]
    cue = True
    for line in text.split("\n"):
        if not line:
            continue
        if line[0].isdigit() and _TIMES.match(line):
            cue = True
            continue
        for w in _line_words(line):
            if w == _END or w == _CUE and cue:
                out.append([])
            elif w != _CUE:
                out[-1].append(w)
        cue = False
    return [s for s in out if s]


def _places(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted key stands in the sorted keys, -1 for those that don't."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


@dataclass
class Models:
    """The two trigram models as sorted arrays: probabilities less discounts, and the weights of the lower orders."""

    ids: dict[str, int]
    unigram: np.ndarray
    lower: np.ndarray  # class x word: weight of the unigrams after a word
    pairs: np.ndarray
    pair: np.ndarray  # class x pair
    upper: np.ndarray  # class x pair: weight of the pairs after two words
    triples: np.ndarray
    triple: np.ndarray  # class x triple
    end: int

    @classmethod
    def fit(cls, triples: pd.DataFrame) -> Models:
        """From ``toxic`` (0, 1), three words ``a, b, c`` and their count ``n``, which may be a fraction; counts of the same add up."""
        triples = triples.groupby(["toxic", "a", "b", "c"], as_index=False, sort=False).n.sum()
        words = pd.unique(pd.concat([triples.a, triples.b, triples.c, pd.Series([_END])]))
        ids = {w: i for i, w in enumerate(words, 1)}
        size, end = len(ids) + 1, ids[_END]
        a, b, c = (triples[k].map(ids).to_numpy(np.int64) for k in "abc")
        kind, n = triples.toxic.to_numpy(int), triples.n.to_numpy(float)
        pairs = np.unique(np.concatenate([a * size + b, b * size + c, [end * size + end]]))
        head, tail = np.searchsorted(pairs, a * size + b), np.searchsorted(pairs, b * size + c)
        keys, at = np.unique(head * size + c, return_inverse=True)
        low, high = _DISCOUNTS
        triple, pair = np.zeros((2, max(len(keys), 1))), np.zeros((2, len(pairs)))
        upper, lower = np.ones((2, len(pairs))), np.ones((2, size))
        unigram = np.full(size, 0.5)
        second = pairs // size
        for k in (0, 1):
            own = kind == k
            total = np.bincount(head[own], n[own], len(pairs))
            triple[k, at[own]] = np.maximum(n[own] - high, 0) / np.maximum(total[head[own]], _TINY)
            upper[k] = 1 - np.bincount(head[own], triple[k, at[own]], len(pairs))
            before = np.bincount(tail[own], np.minimum(n[own], 1), len(pairs))  # words that stand before the pair
            after = np.bincount(second, before, size)
            pair[k] = np.maximum(before - low, 0) / np.maximum(after[second], _TINY)
            lower[k] = 1 - np.bincount(second, pair[k], size)
            unigram += np.bincount(pairs % size, np.minimum(before, 1), size)
        return cls(ids, unigram / unigram.sum(), lower, pairs, pair, upper, keys, triple, end)

    def ratios(self, x: np.ndarray) -> np.ndarray:
        """At each word, or end, of sentences that lie one after another: the log of how much likelier it is in the toxic model.

        Where neither model has seen the word after the one before, the shared backoff counts decide, by the weights that both
        leave to them there.
        """
        size = len(self.unigram)
        b = np.concatenate([[self.end], x[:-1]])
        a = np.where(b == self.end, self.end, np.concatenate([[self.end, self.end], x[:-2]])[: len(x)])
        pair, head = _places(self.pairs, b * size + x), _places(self.pairs, a * size + b)
        triple = np.where(head >= 0, _places(self.triples, head * size + x), -1)
        p = []
        for k in (0, 1):
            second = np.where(pair >= 0, self.pair[k][pair], 0) + self.lower[k][b] * self.unigram[x]
            p.append(np.where(triple >= 0, self.triple[k][triple], 0) + np.where(head >= 0, self.upper[k][head], 1) * second)
        return np.clip(np.log(p[1]) - np.log(p[0]), -WORD_BOUND, WORD_BOUND)

    def sums(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The summed ratio of each sentence, its length with its end, and where that stands in ``x``; none is empty."""
        ends = np.flatnonzero(x == self.end)
        if not len(ends):
            return np.zeros(0), np.ones(0), ends
        begins = np.concatenate([[0], ends[:-1] + 1])
        return np.add.reduceat(self.ratios(x), begins), ends - begins + 1, ends

    def scores(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The score of each sentence, and where it ends in ``x``."""
        total, length, ends = self.sums(x)
        return total / length, ends


class Reader:
    """Word ids of texts; lines repeat, so a worker remembers the words of a bounded number of them."""

    LINES, CHARS = 150_000, 200

    def __init__(self, models: Models):
        self.models, self.known = models, {}

    def _line(self, line: str) -> tuple[bool, np.ndarray]:
        """Whether the line begins a sentence where it begins a cue, and its word ids."""
        ids, words = self.models.ids, _line_words(line)
        begins = words[:1] == [_CUE]
        found = begins, np.array([ids.get(w, 0) for w in words[begins:]], np.int64)
        if len(line) <= self.CHARS:
            if len(self.known) >= self.LINES:
                self.known.clear()
            self.known[line] = found
        return found

    def best(self, texts: list[str]) -> np.ndarray:
        """The highest score of the sentences of each text, NaN for a text without any."""
        known, line, end = self.known.get, self._line, np.array([self.models.end], np.int64)
        parts, counts = [], []
        for text in texts:
            own, cue = [], True
            for x in text.split("\n"):
                if not x:
                    continue
                if x[0].isdigit() and _TIMES.match(x):
                    cue = True
                    continue
                begins, words = known(x) or line(x)
                if begins and cue:
                    own.append(end)
                own.append(words)
                cue = False
            own.append(end)
            parts += own
            counts.append(sum(map(len, own)))
        x = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        text = np.repeat(np.arange(len(texts)), counts)
        is_end = x == self.models.end
        keep = ~is_end | np.concatenate([[False], ~is_end[:-1]])  # no empty sentences
        x, text = x[keep], text[keep]
        score, ends = self.models.scores(x)
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, text[ends], score)
        return np.where(np.isinf(out), np.nan, out)


def _order() -> Column:
    return F.xxhash64(F.col("doc_id"), F.lit("sample"))


def labelled(documents: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, toxic, fold, text`` of at most ``bound`` labelled documents.

    A document's label is what most of its reviewers say; ties, null verdicts and null ids count for nothing.
    """
    votes = labels.where("doc_id is not null and abusive is not null").groupBy("doc_id").agg(F.avg("abusive").alias("share"))
    some = votes.where("share <> 0.5").select("doc_id", (F.col("share") > 0.5).cast("int").alias("toxic")).orderBy(_order(), "doc_id").limit(bound)
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold")
    return documents.where("text is not null").select("doc_id", "text").join(F.broadcast(some), "doc_id").select("doc_id", "toxic", fold, "text")


def _sentence_table(docs: DataFrame) -> DataFrame:
    """``doc_id, toxic, fold, words``: a row for each sentence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [sentences(t) for t in batch.column(3).to_pylist()]
            rows = pa.array(np.repeat(np.arange(len(cut)), [len(s) for s in cut]))
            words = pa.array([s for doc in cut for s in doc], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(rows) for k in range(3)), words], ["doc_id", "toxic", "fold", "words"])

    return docs.select("doc_id", "toxic", "fold", "text").mapInArrow(run, "doc_id bigint, toxic int, fold int, words array<string>")


def within_words(table: DataFrame, most: int = MAX_WORDS) -> DataFrame:
    """The sentences of the documents that come first by the hash of their id and have at most ``most`` words, ends included, in all."""
    size = F.sum(F.size("words") + 1).cast("long").alias("n")
    if (table.agg(size).first()[0] or 0) <= most:
        return table
    order = Window.orderBy(_order(), "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # a row for each labelled document
    kept = table.groupBy("doc_id").agg(size).withColumn("upto", F.sum("n").over(order)).where(F.col("upto") <= most)
    return table.join(F.broadcast(kept.select("doc_id")), "doc_id", "left_semi")


def _triples(table: DataFrame, weight: Column | None = None) -> pd.DataFrame:
    """The counts of all triples of words of the sentences of a bounded number of documents, by label and fold."""
    padded = F.concat(F.array(F.lit(_END), F.lit(_END)), "words", F.array(F.lit(_END)))
    three = F.transform(F.sequence(F.lit(1), F.size("words") + 1), lambda i: F.slice(padded, i, 3))
    weighted = table.select("toxic", "fold", "words", (F.lit(1.0) if weight is None else weight).alias("w"))
    rows = weighted.select("toxic", "fold", "w", F.explode(three).alias("t")).groupBy("toxic", "fold", "t").agg(F.sum("w").alias("n"))
    return rows.select("toxic", "fold", F.col("t")[0].alias("a"), F.col("t")[1].alias("b"), F.col("t")[2].alias("c"), "n").toPandas()


def _judge(table: DataFrame, counts: pd.DataFrame) -> tuple[Column, Column]:
    """The sum and the score of each sentence of ``table``, by models fitted to the counts of the other folds."""
    shared = table.sparkSession.sparkContext.broadcast({f: Models.fit(counts[counts.fold != f]) for f in range(FOLDS)})

    @F.pandas_udf("sum double, score double")
    def judge(fold: pd.Series, words: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"sum": 0.0, "score": 0.0}, fold.index)
        for f, own in words.groupby(fold):
            m = shared.value[f]
            total, length, _ = m.sums(np.array([i for s in own for i in [*(m.ids.get(w, 0) for w in s), m.end]], np.int64))
            out.loc[own.index, "sum"] = total
            out.loc[own.index, "score"] = total / length
        return out

    found = judge("fold", "words")
    return found["sum"], found["score"]


def fit(documents: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED, rounds: int = ROUNDS, words: int = MAX_WORDS) -> tuple[Models, float]:
    """The models and the cutoff, from at most ``bound`` labelled documents with at most ``words`` words."""
    table = within_words(stage(_sentence_table(labelled(documents, labels, bound)), "moderation-sentences"), words)
    counts = _triples(table)
    ordinary, toxic = counts[counts.toxic == 0], table.where("toxic = 1")
    prior = math.log(TOXIC_SHARE / (1 - TOXIC_SHARE))
    for _ in range(rounds):
        total = _judge(toxic, counts)[0]
        counts = pd.concat([ordinary, _triples(toxic, 1 / (1 + F.exp(-(total + prior))))])
    score = _judge(table, counts)[1]
    best = table.select("doc_id", "toxic", score.alias("score")).groupBy("doc_id", "toxic").agg(F.max("score").alias("score"))
    return Models.fit(counts), _cutoff(best.select("score", "toxic").toPandas())


def _cutoff(judged: pd.DataFrame) -> float:
    """The score at which the labels are met best (by F1), drawn to the usual one where they are few.

    Without a toxic label nothing is known of toxic texts, and no score is a case.
    """
    judged = judged.dropna().sort_values("score", ascending=False)
    hits, cases = judged.toxic.cumsum().to_numpy(), int(judged.toxic.sum())
    if not cases:
        return math.inf
    above = judged.score.to_numpy()
    cuts = (above + np.append(above[1:], above[-1] - 1)) / 2
    near = USUAL_WEIGHT * np.exp(-((cuts - USUAL_CUTOFF) ** 2))
    f1 = (2 * hits + 2 * near) / (np.arange(1, len(judged) + 1) + cases + 2 * USUAL_WEIGHT)
    return float(cuts[np.argmax(f1)])


_GROUP_CHARS = 2 << 20


def scored(documents: DataFrame, models: Models, *keep: str) -> DataFrame:
    """``doc_id``, the columns of ``keep`` and ``score``, which is null for a text without words.

    Whole texts are read. Rows sent twice come out twice, and an empty table gives an empty one.
    """
    shared = documents.sparkSession.sparkContext.broadcast(models)
    picked = documents.select("doc_id", *keep, "text")
    schema = T.StructType([*picked.drop("text").schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            best, some, size = [], [], 0
            for t in texts:
                some.append(t)
                size += len(t)
                if size >= _GROUP_CHARS:
                    best.append(reader.best(some))
                    some, size = [], 0
            best.append(reader.best(some))
            score = pa.array(np.concatenate(best), pa.float64(), from_pandas=True)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], score], schema.names)

    return picked.mapInArrow(run, schema)


def moderated(documents: DataFrame, labels: DataFrame, *keep: str) -> DataFrame:
    """``doc_id``, the columns of ``keep``, ``score`` and ``abusive``: whether the score reaches the cutoff; never for texts without words."""
    models, cutoff = fit(documents, labels)
    return scored(documents, models, *keep).withColumn("abusive", F.coalesce(F.col("score") >= cutoff, F.lit(False)))


def rates(judged: DataFrame, source: str = "source") -> DataFrame:
    """Per source its documents, how many are abusive, and their share; null is a source of its own."""
    return judged.groupBy(source).agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if("abusive").alias("n_abusive"), F.avg(F.col("abusive").cast("int")).alias("rate")
    )
