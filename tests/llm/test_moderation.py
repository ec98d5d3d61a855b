import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spotweave.llm import moderation as m


@pytest.mark.parametrize(
    ("text", "plain"),
    [
        ("You IDIOT!", [["you", "ldlot"]]),
        ("y0u 1diot", [["you", "ldlot"]]),
        ("уоu іdіоt", [["you", "ldlot"]]),  # letters of another script
        ("ｉｄｉｏｔ", [["ldlot"]]),
        ("i d i o t", [["ldlot"]]),
        ("i.d.i.o.t", [["ldlot"]]),
        ("idiooooot", [["ldlot"]]),
        ("iiidiot", [["ldlot"]]),
        ("1\n00:00:01,000 --> 00:00:02,000\nYou are\n\n2\n00:00:03,000 --> 00:00:04,000\nan idiot.\n", [["you", "are", "an", "ldlot"]]),
        ("1\n00:00:01,000 --> 00:00:02,000\nNo end\n\n2\n00:00:03,000 --> 00:00:04,000\nNew cue\n", [["no", "end"], ["new", "eue"]]),
        ("{10}{20}One|two.\n{30}{40}Three", [["one", "two"], ["three"]]),
        ("WEBVTT\n\n00:01.000 --> 00:02.000\n<i>Hi</i> (laughs) there", [["hl"], ["laughs"], ["there"]]),
        ("crÃ©tin crétin", [["eretln", "eretln"]]),
        ("", []),
        ("12:00:01\n\n7", []),
    ],
)
def test_sentences(text, plain):
    assert m.sentences(text) == plain


def corpus(n, seed=0):
    """Texts of ordinary sentences, of which some also hold a nasty one; one label in ten is wrong."""
    r = random.Random(seed)
    names, things, places = ["Ann", "Bob", "Cyd", "Dan"], ["lamp", "boat", "map", "key", "dog"], ["mill", "quay", "barn", "town"]
    fine = [lambda: f"{r.choice(names)} left the {r.choice(things)} at the {r.choice(places)}.", lambda: f"Where is the {r.choice(things)}?", lambda: f"We met in {r.choice(places)}, {r.choice(names)}.",
            lambda: "The pig ate well.", lambda: f"Do not call {r.choice(names)} a pig, that is cruel."]
    nasty = [lambda: f"You are a filthy pig, {r.choice(names)}!", lambda: f"I hope you choke, {r.choice(names)}.", lambda: "Nobody would miss scum like you."]
    docs, labels, truth = [], [], {}
    for i in range(n):
        text = [r.choice(fine)() for _ in range(8)]
        truth[i] = r.random() < 0.15
        if truth[i]:
            text.insert(r.randrange(9), r.choice(nasty)())
        docs.append((i, "\n".join(text), f"s{i % 3}"))
        if r.random() < 0.6:
            labels.append((i, int(truth[i] != (r.random() < 0.1))))
    return docs, labels, truth


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels, truth = corpus(1500)
    d = spark.createDataFrame([*docs, (9001, None, "s0"), (9002, "", None), (9003, " \n", None)], "doc_id bigint, text string, source string")
    lab = spark.createDataFrame([*labels, (None, 1), (3, None), (123456, 1)], "doc_id bigint, abusive int")
    return m.moderated(d, lab, "source").cache(), truth, d, lab


def test_held_out_accuracy(judged):
    """Of all texts, most of them without a label, and despite wrong labels."""
    found = {r.doc_id: r.abusive for r in judged[0].collect()}
    hits = sum(found[i] and t for i, t in judged[1].items())
    assert hits / sum(found[i] for i in judged[1]) > 0.95 and hits / sum(judged[1].values()) > 0.95


def test_texts_without_words(judged):
    rows = {r.doc_id: (r.score, r.abusive) for r in judged[0].where("doc_id > 9000").collect()}
    assert rows == {9001: (None, False), 9002: (None, False), 9003: (None, False)}


def test_rates(judged):
    rows = m.rates(judged[0]).collect()
    assert {r.source for r in rows} == {"s0", "s1", "s2", None} and all(abs(r.rate - r.n_abusive / r.n_docs) < 1e-12 for r in rows)


def test_probabilities_add_up(spark):
    counts = pd.DataFrame([(k, 0, a, b, c, n) for k in (0, 1) for a, b, c, n in [(".", ".", "a", 3), (".", "a", "b", 2.5), ("a", "b", ".", 2), (".", "a", ".", 0.5), (".", ".", "b", 1)]],
                          columns=["toxic", "fold", "a", "b", "c", "n"])
    models = m.Models.fit(counts)
    words = np.arange(len(models.unigram))
    for k in (0, 1):
        second = models.lower[k][:, None] * models.unigram[None, :]
        b, c = models.pairs // len(words), models.pairs % len(words)
        second[b, c] += models.pair[k]
        assert np.allclose(second.sum(1), 1)


def test_few_or_no_labels(spark):
    docs, _, _ = corpus(20)
    d = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    none = spark.createDataFrame([], "doc_id bigint, abusive int")
    assert m.moderated(d, none).where("abusive").count() == 0
    ties = spark.createDataFrame([(1, 0), (1, 1)], "doc_id bigint, abusive int")
    assert m.moderated(d, ties).count() == 20
    one = spark.createDataFrame([(1, 1)], "doc_id bigint, abusive int")
    assert m.moderated(d, one).count() == 20
    assert m.moderated(d.limit(0), one).count() == 0


def test_long_text(spark, judged):
    models, cutoff = m.fit(judged[2], judged[3])
    long = "We met in town, Ann.\n" * 20_000 + "You are a filthy pig, Bob!"
    df = spark.createDataFrame([(1, long), (2, "We met in town, Ann.\n" * 20_000)], "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in m.scored(df, models).collect()}
    assert got[1] >= cutoff > got[2]


def test_clashing_columns_and_repeated_rows(spark, judged):
    extra = {n: F.lit("x") for n in ("score", "abusive", "toxic", "fold", "words", "share", "held")}
    d = judged[2].unionByName(judged[2].where("doc_id = 5")).withColumns(extra)
    got = m.moderated(d, judged[3].withColumns({n: F.lit(1) for n in ("toxic", "share", "text")}), "source")
    assert got.columns == ["doc_id", "source", "score", "abusive"] and got.where("doc_id = 5").count() == 2 and got.count() == judged[2].count() + 1


def test_the_words_fitted_to_are_bounded(spark):
    table = spark.createDataFrame([(i, 0, 0, ["w"] * (i + 1)) for i in range(20)], "doc_id bigint, toxic int, fold int, words array<string>")
    assert m.within_words(table, 10_000).count() == 20
    kept = m.within_words(table, 60).collect()
    assert 0 < len(kept) < 20 and sum(len(r["words"]) + 1 for r in kept) <= 60
    assert m.within_words(table, 0).count() == 0 and m.within_words(table.limit(0), 5).count() == 0


def test_unseen_pairs_are_judged_by_the_backoff():
    import pandas as pd

    counts = pd.DataFrame([(1, "a", "b", "c", 5.0), (0, "a", "b", "d", 5.0), (0, "d", "e", "c", 2.0)], columns=["toxic", "a", "b", "c", "n"])
    models = m.Models.fit(counts)
    x = np.array([models.ids["c"], models.ids["e"], models.end])
    total, length, _ = models.sums(x)
    assert models.scores(x)[0][0] == total[0] / length[0] and np.isfinite(models.ratios(x)).all()
