from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import quality_rules, rule_ensemble, stats, toxicity
from textloom.llm.common import held_out

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measure(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(inside), len(lines),
        len(re.findall("[A-Z]", text)), len(re.findall("[a-z]", text)),
    )


@pytest.mark.parametrize("seed", range(40))
def test_measures_equal_brute_force(seed):
    draw = random.Random(seed)
    parts = ["a", "b", "AB", "ß", "\n", " ", "\t", "\x1c", "\x85", "\xa0", "#", "|", "é", "\x0b", "<x>"]
    text = "".join(draw.choice(parts) for _ in range(draw.randrange(200)))
    assert quality_rules.measure(text) == brute_measure(text)
    words = [str(draw.randrange(4)) for _ in range(draw.randrange(30))]
    assert quality_rules.measure(" ".join(words))[4] == brute_measure(" ".join(words))[4]


def test_ledger_policies_and_ablations(spark, odd, docs):
    rows = quality_rules.ledger(odd)
    got = rows.collect()
    assert Counter((r.doc_id, r.n_words) for r in got) == Counter(
        (r.doc_id, brute_measure(r.text)[0]) for r in odd.collect()
    )
    names = list(quality_rules.RULES)
    texts = ["AB CD " * 40, "word " * 80, " ".join(f"w{i}" for i in range(80)), "# " * 60, None, "line\nline\nline\n" * 20]
    ledger = quality_rules.ledger(docs(list(enumerate(texts))))
    policy = quality_rules.POLICIES["v2"]
    kept = {r.doc_id: r.kept for r in quality_rules.apply_policy(ledger, policy).collect()}
    assert kept == {0: False, 1: False, 2: True, 3: False, 4: False, 5: False}
    bits = {r.doc_id: r.failed for r in ledger.collect()}
    report = {r.rule: r for r in quality_rules.ablations(ledger, policy).collect()}
    for rule in policy.rules:
        without = policy.mask & ~(1 << names.index(rule))
        assert report[rule].kept_without == sum(b & without == 0 for b in bits.values())
        assert report[rule].failed_rule == sum(b >> names.index(rule) & 1 for b in bits.values())
    assert quality_rules.ledger(docs([])).count() == 0


def test_fold():
    assert toxicity.fold("ІDІОТ 1d10t! Stüpid­ly $cum foo_bar 2024 x") == " idiot idiot stupidly scum foo bar 2024 x "
    assert toxicity.fold(None) == toxicity.fold(" \n ") == " "
    assert toxicity.fold("a" * 300_000) == f" {'a' * 300_000} "
    assert toxicity.fold("1" * 300_000 + "!") == f" {'1' * 300_000} "


def test_matcher_equals_brute_force():
    draw = random.Random(1)
    weights = ((" bad", 2.0), (" bad ", 3.0), (" worse ", 1.5), (" ab", 0.5))
    matcher = toxicity.Lexicon(weights, exceptions=("bad luck", "not worse")).matcher()
    for _ in range(500):
        words = [draw.choice(["bad", "badly", "luck", "not", "worse", "ab", "abba", "x"]) for _ in range(draw.randrange(12))]
        total, number = 0.0, 0
        for i, w in enumerate(words):
            padded = f" {w} "
            best = max([v for p, v in weights if padded.startswith(p)], default=0)
            excused = (w == "bad" and words[i + 1 : i + 2] == ["luck"]) or (w == "worse" and i and words[i - 1] == "not")
            if best and not excused:
                total, number = total + best, number + 1
        found = matcher.features(" ".join(words))
        assert found[3] == number and found[0] == pytest.approx(np.log1p(total))


def labelled(spark, docs, texts, target):
    rows = [(i, t) for i, (t, _) in enumerate(texts)]
    labels = spark.createDataFrame(
        [(i, y if target == "quality" else 1, y if target == "toxic" else 0) for i, (_, y) in enumerate(texts)],
        "doc_id long, quality int, toxic int",
    )
    return docs(rows), labels


def toxic_texts(n=400):
    draw = random.Random(8)
    out = []
    for i in range(n):
        words = [draw.choice(["plain", "words", "about", "trees", "rivers", "and"]) + str(draw.randrange(30)) for _ in range(40)]
        y = int(i % 5 == 0)
        if y:
            words.insert(draw.randrange(40), draw.choice(["grzmk", "grzmkig", "GRZMKL", "grzmk5"]))
        out.append((" ".join(words), y))
    return out


def test_toxicity_learns_held_out_texts(spark, docs):
    frame, labels = labelled(spark, docs, toxic_texts(), "toxic")
    rows = {r.doc_id: r for r in toxicity.classify(frame, labels).collect()}
    y = {r.doc_id: r.toxic for r in labels.collect()}
    held = [i for i in rows if rows[i].held_out]
    assert 40 < len(held) < 130
    assert all(rows[i].predicted == y[i] and 0 <= rows[i].score <= 1 for i in held)
    kept = toxicity.accepted(frame, labels)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i in y if rows[i].score < 0.5}


def test_exceptions_are_learned(spark, docs):
    draw = random.Random(21)
    texts = toxic_texts(600)
    # harmless beside "lamp", in every fourth of the other texts
    texts = [(f"{t} grzmk lamp" if not y and draw.random() < 0.25 else t, y) for t, y in texts]
    frame, labels = labelled(spark, docs, texts, "toxic")
    lexicon = toxicity.train(frame, labels, ~toxicity.held_out("doc_id", 5, 0))
    assert any(p.startswith(" grzm") for p, _ in lexicon.weights)
    assert "grzmk lamp" in lexicon.exceptions and all("lamp" in e or "grzm" in e for e in lexicon.exceptions)
    matcher = lexicon.matcher()
    assert matcher.features("the grzmk lamp")[3] == 0 and matcher.features("the grzmk tree")[3] > 0
    rows = {r.doc_id: r for r in toxicity.classify(frame, labels).collect()}
    y = {r.doc_id: r.toxic for r in labels.collect()}
    held = [i for i in rows if rows[i].held_out]
    assert sum(rows[i].predicted == y[i] for i in held) >= 0.98 * len(held)


@pytest.mark.parametrize("module", [toxicity, rule_ensemble])
def test_layouts_of_a_table_train_one_model(spark, docs, module):
    """Ids that repeat with other texts, and near copies, whose rows come in another order."""
    draw = random.Random(31)
    texts = [(t if i % 3 else t + " and some more", y) for i, (t, y) in enumerate(toxic_texts(300))]
    frame, labels = labelled(spark, docs, texts, "toxic")
    if module is rule_ensemble:
        labels = labels.withColumn("quality", F.col("toxic"))
    other = [(i, " ".join(draw.sample(t.split(), 30)) + (" grzmk" if draw.random() < 0.3 else "")) for i, (t, _) in enumerate(texts)]
    frame = frame.unionByName(docs(other))
    found = []
    for layout in (frame.repartition(3, "text"), frame.orderBy(F.desc("doc_id"), F.desc("text")).coalesce(1), frame.repartition(7)):
        rows = module.classify(layout, labels).select("doc_id", "score").collect()
        found.append(sorted((r.doc_id, round(r.score, 12)) for r in rows))
    assert found[0] == found[1] == found[2]


def test_likeness_tells_copies_from_shared_lines():
    draw = random.Random(5)
    word = lambda: f"w{draw.randrange(5000)}"
    line = " ".join(word() for _ in range(30))
    texts = [" ".join(word() for _ in range(90)) + " " + line for _ in range(300)]
    keys = [toxicity.likeness(t) for t in texts]
    assert len({k for k, _ in keys}) > 290 and len({k for _, k in keys}) > 290
    near = [" ".join([*(w if draw.random() > 0.01 else word() for w in texts[0].split())]) for _ in range(100)]
    first = toxicity.likeness(texts[0])
    assert sum(any(a == b for a, b in zip(toxicity.likeness(t), first)) for t in near) > 70


def test_lexicon_comes_from_the_labels_alone(spark, docs):
    """Known insults are patterns where training labels bear them out, and only there."""
    few = [("plain words and idiot", 1), ("calm moron rivers", 1), ("trees and trash", 1)]
    sparse = few + [(f"plain words about trees {i}", 0) for i in range(60)]
    frame, labels = labelled(spark, docs, sparse, "toxic")
    everything = F.lit(True)
    assert toxicity.train(frame, labels, everything).weights == ()
    # as frequent among toxic as among other texts, or nearly so: odds between 0 and the least ones
    draw = random.Random(3)
    texts = [(f"{text} {'idiot' if draw.random() < (0.3 if y else 0.2) else 'stone'}", y) for text, y in toxic_texts()]
    frame, labels = labelled(spark, docs, texts, "toxic")
    learned = dict(toxicity.train(frame, labels, everything).weights)
    assert learned and not [p for p in learned if not p.startswith(" grzm")]
    # borne out by the labels it is learned like any other word
    texts = [(text.replace("grzmk", "idiot").replace("GRZMK", "idiot"), y) for text, y in toxic_texts()]
    frame, labels = labelled(spark, docs, texts, "toxic")
    assert any(p.startswith(" idio") for p, _ in toxicity.train(frame, labels, everything).weights)


def test_held_out_follows_the_crc(spark):
    import zlib

    frame = spark.createDataFrame([(i,) for i in range(200)] + [(None,)], "doc_id long")
    got = {r.doc_id: r.h for r in frame.select("doc_id", held_out("doc_id", 5, 0).alias("h")).collect() if r.doc_id is not None}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}


def quality_texts(n=500):
    draw = random.Random(6)
    out = []
    for i in range(n):
        words = [draw.choice(["calm", "river", "green", "valley", "stone"]) + draw.choice("abcdef") for _ in range(60)]
        y = int(i % 3 != 0)
        if not y:
            words = [w + draw.choice(["###", "&&&"]) for w in words] if i % 2 else [w for w in words for _ in range(4)]
        out.append((" ".join(words), y))
    return out


def test_rule_ensemble_learns_and_compiles(spark, docs):
    frame, labels = labelled(spark, docs, quality_texts(), "quality")
    rows = rule_ensemble.classify(frame, labels).collect()
    y = {r.doc_id: r.quality for r in labels.collect()}
    held = [r for r in rows if r.held_out]
    assert len(held) > 60
    assert np.mean([r.predicted == y[r.doc_id] for r in held]) > 0.97
    # the compiled expression equals the model in numpy
    training = ~held_out("doc_id", 4, 2)
    model = rule_ensemble.train(rule_ensemble.with_statistics(frame), labels, training)
    x = np.array([[getattr(r, f) for f in stats.FEATURES] for r in rows])
    assert np.allclose(model.score(x), [r.score for r in rows])
    assert 0 < len(model.rules) < 60
    kept = rule_ensemble.accepted(frame, labels)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_statistics():
    names = dict(zip(stats.FEATURES, stats.statistics("Ab| | é# ab\n\n1, x. x. x.")))
    assert names["n_words"] == 8 and names["n_lines"] == 2 and names["pipe_rate"] == 1 / 8
    assert names["symbol_words"] == 1 / 8 and names["same_next_rate"] == 2 / 8 and names["long_word"] == 3
    assert stats.statistics(None) == stats.statistics(" \n") == (0.0,) * len(stats.FEATURES)


def test_lasso_shrinks_to_nothing_and_fits():
    draw = np.random.default_rng(0)
    z = (draw.random((600, 8)) < 0.5).astype(float)
    y = (draw.random(600) < 1 / (1 + np.exp(-(3 * z[:, 0] - 2 * z[:, 3])))).astype(float)
    w, _ = rule_ensemble.lasso_logistic(z, y, 0.01)
    assert w[0] > 1.5 and w[3] < -0.8 and np.abs(w[[1, 2, 4, 5, 6, 7]]).max() < 0.4
    assert not rule_ensemble.lasso_logistic(z, y, 1.0)[0].any()


@pytest.mark.parametrize("module", [toxicity, rule_ensemble])
def test_odd_rows_and_labels(spark, odd, docs, module):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(4, 1, 0), (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        rows = module.classify(odd, labels).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        assert module.accepted(odd, labels).columns == odd.columns
    assert module.classify(docs([]), one).count() == 0
    assert module.classify(docs([]), none).where(F.col("score") > 1).count() == 0
