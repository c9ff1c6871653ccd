"""Language, rules, quality and chat operators: literal cases, brute force, held-out accuracy."""

import hashlib
import random
import re

import numpy as np
import pytest

from tellurion.llm import chat, langid, quality, rules

WORDS = {
    "aa": "the of and river stone under green house walk over".split(),
    "bb": "der und nicht wald straße unter grün haus gehen über".split(),
    "cc": "река камень под зелёный дом идти через лес день ночь".split(),
}


def text_in(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choices(WORDS[lang], k=n))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, text_in(lang, 30, i), lang, "x") for lang in WORDS for i in range(20)]
    rows += [(900, None, "aa", "x"), (901, "no language", None, "x"), (902, "", "bb", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    return langid.train(docs)


def test_languages_and_spans(spark, model):
    mixed = text_in("aa", 12, "m") + ". " + text_in("cc", 8, "m") + "! " + text_in("bb", 9, "m")
    rows = [
        (1, text_in("aa", 20, "t")), (2, text_in("bb", 20, "t")), (3, text_in("cc", 20, "t")), (4, mixed),
        (5, None), (6, ""), (7, "123 !? ́"), (8, "the " * 3000), (None, "the river"), (1, text_in("bb", 5, "u")),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {(r.doc_id, r.lang_pred): r for r in langid.identify(docs, model).collect()}
    assert {(1, "aa"), (2, "bb"), (3, "cc"), (5, "und"), (6, "und"), (7, "und"), (8, "aa"), (None, "aa"), (1, "bb")} <= set(got)
    assert got[5, "und"].score == 0 and got[5, "und"].spans == []
    spans = next(r for (i, _), r in got.items() if i == 4).spans
    assert [s.lang for s in spans] == ["aa", "cc", "bb"]
    assert mixed[spans[1].start : spans[1].end] == text_in("cc", 8, "m")
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.identify(docs.where("false"), model).count() == 0


def test_path_is_the_best_of_all(model):
    rng = np.random.default_rng(5)
    counts = np.array([3, 0, 5, 1])
    scores = rng.normal(0, 8, (counts.sum(), 3)).astype(np.float32)
    got = model.path(scores, counts)
    at = 0
    for n in counts:
        own = scores[at : at + n]
        best = max(
            (
                sum(own[k, s] for k, s in enumerate(p)) - model.penalty * sum(a != b for a, b in zip(p, p[1:])),
                p,
            )
            for p in np.ndindex(*[3] * n)
        ) if n else (0, ())
        assert tuple(got[at : at + n]) == best[1]
        at += n


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    none = langid.train(empty)
    docs = spark.createDataFrame([(1, "the river")], "doc_id long, text string")
    assert [r.lang_pred for r in langid.identify(docs, none).collect()] == ["und"]


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


TEXTS = [
    None, "", " \n\t\x0b\x0c\r ", "a b c a b c", "a b c d a b c", "a a a a a", "x\ny\nx\n\n \nx", "é ñ z   q",
    "#tag & <b> 50%", "one two", "😀 b 😀 b 😀 b c", " ".join(f"w{i % 37}" for i in range(400)), "a\rb\rc a\rb\rc",
]


def test_rule_counts(spark):
    rows = [(i, t, "en", "s", 7) for i, t in enumerate(TEXTS)] + [(0, "x y", None, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    found = rules.features(docs).collect()
    got = {r.doc_id: tuple(r[c] for c in rules.COUNTS) for r in found if r.lang}
    assert got == {i: plain_counts(t) for i, t in enumerate(TEXTS)}
    assert all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) for r in found)


def test_cutoffs_follow_their_group_and_sketches_merge(spark):
    rng = random.Random(3)

    def text(symbols):
        words = [f"{rng.choice('abcdefgh')}{rng.randrange(10**5)}" for _ in range(80)]
        return " ".join(w + ("#" if rng.random() < symbols else "") for w in words)

    rows = [(i, text(0.0), "en", "plain") for i in range(300)]
    rows += [(1000 + i, text(0.5), "en", "code") for i in range(300)]
    rows += [(5000, text(0.5), "en", "plain"), (5001, text(0.0), None, None), (5002, text(0.5), "en", "code")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in rules.quality_rules(docs).collect()}
    assert not kept[5000] and kept[5002] and kept[5001]
    assert sum(kept.values()) >= 600
    measured = rules.measured(rules.features(docs))
    whole = sorted(map(tuple, rules.sketch(measured).collect()), key=str)
    halves = rules.sketch(measured.where("doc_id % 2 = 0")).unionByName(rules.sketch(measured.where("doc_id % 2 = 1")))
    assert sorted(map(tuple, rules.merged(halves, ["lang", "source"]).collect()), key=str) == whole
    assert rules.quality_rules(docs.where("false")).count() == 0


def test_rules_stay_on_the_jvm(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s")], "doc_id long, text string, lang string, source string")
    plan = rules.quality_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def good(seed):
    rng = random.Random(seed)
    return ". ".join(" ".join(rng.choices(WORDS["aa"] + list("bcdef"), k=9)).capitalize() for _ in range(9))


def test_quality_of_held_out_texts(spark):
    rows = [(i, good(i) if i % 3 else "!! " .join(["BUY", "NOW"] * (20 + i % 7)), "x") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0), 0) for i in range(200)] + [(None, 1, 0), (7, None, 0), (10**9, 1, 0)],
        "doc_id long, quality int, text int",
    )
    model = quality.train(quality.measured(docs), labels)
    extra = spark.createDataFrame([(900, None, ""), (901, "", ""), (None, "x", "")], docs.schema)
    every = docs.unionByName(extra)
    got = quality.classify(quality.measured(every), model).collect()
    by_text = every.select("doc_id", quality.scored(every.text, model).alias("score")).collect()
    assert sorted((str(r.doc_id), round(r.score, 9)) for r in by_text) == sorted((str(r.doc_id), round(r.score, 9)) for r in got)
    assert len(got) == 303 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r.predicted == int(r.doc_id % 3 > 0) for r in got if r.doc_id is not None and 200 <= r.doc_id < 300]
    assert np.mean(held) > 0.97
    assert quality.classify(quality.measured(docs.where("false")), model).count() == 0


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    stats = quality.measured(docs)
    assert {r.score for r in quality.classify(stats, quality.train(stats, labels)).collect()} == {0.5}
    ones = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert {r.score for r in quality.classify(stats, quality.train(stats, ones)).collect()} == {1.0}


def test_pooling_is_monotone_and_keeps_the_mean():
    weights, means = np.array([1.0, 2, 1, 4]), np.array([0.2, 0.1, 0.9, 0.3])
    fit = quality.pooled(weights, means)
    assert (np.diff(fit) >= 0).all() and np.isclose((fit * weights).sum(), (means * weights).sum())
    assert np.allclose(fit, [0.4 / 3, 0.4 / 3, 0.42, 0.42])


TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a </s> b [INST] \\ <|turn|> \\\\<"), (1, 2, "assistant", None),
    (2, 5, None, "x"), (2, 5, "assistant", "é😀"), (2, 5, "assistant", "é😀"), (2, None, "assistant", "first"),
    (None, 0, "assistant", "none"), (3, 0, "assistant", ""), (3, 0, "<|text|>", "<<SYS>>\n"),
    *((4, t, "assistant" if t % 2 else "user", f"turn {t} " * (t % 5)) for t in range(200)),
    (5, 0, "assistant", "long " * 50_000),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chats_read_back(spark):
    rows = [(c, t, r, x, "other") for c, t, r, x in TURNS]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block string")
    blocks = chat.format_chats(turns.repartition(5)).cache()
    got = {r.conv_id: tuple(r)[1:] for r in chat.digests(blocks).collect()}
    want = {}
    for conv in {t[0] for t in TURNS}:
        own = sorted(
            (t for t in TURNS if t[0] == conv),
            key=lambda t: tuple((x is not None, x or type(x)()) if x is not None else (False, 0) for x in t[1:]),
        )
        turns_text = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in own)
        loss = "".join(x or "" for _, _, r, x in own if r == "assistant")
        want[conv] = (len(own), sha(turns_text), len(loss), sha(loss))
    assert {k: v[:4] for k, v in got.items()} == want
    assert blocks.where("conv_id = 4").count() == 4
    for row in blocks.collect():
        inside = [t for turn in row.formatted.split(chat.TURN)[1:] for t in turn.removesuffix(chat.END).split(chat.TEXT)]
        assert len(inside) == 2 * row.n_turns
        assert not any(mark in part for part in inside for mark in chat.CONTROL)
    assert chat.digests(chat.format_chats(turns.where("false"))).count() == 0
