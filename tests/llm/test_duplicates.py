"""Near duplicates, repeated passages and benchmark passages against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tellurion.llm import decontam, jaccard, repeats
from tellurion.llm.runindex import NOWHERE, RunIndex

SYLLABLES = "ta re no mi la so du ke pi ra".split()


def words(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


def corpus():
    """Random texts, exact and near copies, chains of near copies, a shared passage, odd texts."""
    rng = random.Random(11)
    shared = " ".join(words(rng, 60))
    texts = [" ".join(words(rng, rng.randint(5, 120))) for _ in range(40)]
    for base in range(8):
        own = texts[base].split()
        for _ in range(rng.randint(1, 12)):
            near = list(own)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                near[rng.randrange(len(near))] = words(rng, 1)[0]
            own = near if base % 2 else own
            texts.append(" ".join(near).title() if rng.random() < 0.3 else " ".join(near))
    texts += [f"{' '.join(words(rng, 30))} {shared} {' '.join(words(rng, 30))}" for _ in range(12)]
    texts += [shared, shared + " end", None, "", "  \n ", "one two", "One\tTWO", "one", " ".join(words(rng, 3000))]
    texts += [texts[-1] + " tail"]
    return list(enumerate(texts))


def plain_sets(text):
    own = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for space in "\t\n\x0b\x0c\r":
        own = own.replace(space, " ")
    own = [w for w in own.split(" ") if w]
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def test_classes_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 3)
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    rows = corpus()
    docs = spark.createDataFrame([(i * 7, t, i) for i, t in rows], "doc_id long, text string, key int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs.repartition(3)).collect()}
    sets = {i * 7: plain_sets(t) for i, t in rows}
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                label[y] = x
    assert got == {i: (len(s), top(i)) for i, s in sets.items()}
    assert sum(c != i for i, (_, c) in got.items()) >= 20


def components_by_hand(rows):
    sets = {i: plain_sets(t) for i, t in rows}
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                label[y] = x
    return {i: (len(s), top(i)) for i, s in sets.items()}


@pytest.mark.parametrize("changed", [2, 3, 4])
def test_families_near_the_threshold(spark, monkeypatch, changed):
    """Copies of one text, each changed in a few words: similarities from 0.7 to 0.9."""
    monkeypatch.setattr(jaccard, "PART", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng = random.Random(changed)
    own, texts = words(rng, 200), []
    for _ in range(45):
        near = list(own)
        for _ in range(changed):
            near[rng.randrange(200)] = "".join(words(rng, 3))
        texts.append(" ".join(near))
    rows = list(enumerate(texts)) + [(100 + i, " ".join(words(rng, 150))) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()}
    assert got == components_by_hand(rows)


def test_a_family_below_the_threshold_asks_parts_and_not_pairs(spark, monkeypatch):
    asked, real = [], jaccard.staged
    monkeypatch.setattr(jaccard, "staged", lambda f, name: (asked.append(real(f, name)) or asked[-1]) if name == "queries" else real(f, name))
    rng = random.Random(8)
    own, numbers = words(rng, 200), []
    for n in (100, 200):
        texts = []
        for _ in range(n):
            near = list(own)
            for at in rng.sample(range(200), 7):
                near[at] = "".join(words(rng, 3))
            texts.append(" ".join(near))
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
        assert got == {i: c for i, (_, c) in components_by_hand(list(enumerate(texts))).items()}
        numbers.append(asked[-1].count())
    assert numbers[1] <= 12 * 200


def test_a_linked_family_gives_links_by_classes_and_not_by_parts(spark, monkeypatch):
    """A quarter of the pairs are links, so most classes are not linked with the first one."""
    given, real = [], jaccard.staged
    monkeypatch.setattr(jaccard, "staged", lambda f, name: (given.append(real(f, name)) or given[-1]) if name == "links" else real(f, name))
    monkeypatch.setattr(jaccard, "PART", 2)
    rng = random.Random(9)
    own, texts = words(rng, 180), []
    for _ in range(160):
        near = list(own)
        for at in rng.sample(range(180), 2):
            near[at] = "".join(words(rng, 3))
        texts.append(" ".join(near))
    rows = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: c for i, (_, c) in components_by_hand(rows).items()}
    assert sum(links.count() for links in given) <= 10 * len(rows)


def test_repeated_rows_are_one_set(spark):
    rng = random.Random(3)
    a = " ".join(words(rng, 100))
    b = " ".join([*a.split()[:-9], *words(rng, 9)])
    rows = [(1, a)] * 40 + [(2, b)] * 40 + [(3, a + " x")] * 40 + [(2, "another text under the id of the second")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    keys = jaccard.staged(jaccard.described(docs, 5), "k").where("times is null").groupBy("key").agg(
        jaccard.F.min("doc_id").alias("first_id")
    )
    assert jaccard._token_rows(docs, keys, keys.select("key"), 5).count() == 4
    sets = {1: plain_sets(a), 2: plain_sets(b), 3: plain_sets(a + " x")}
    both = len(sets[1] & sets[2]) / len(sets[1] | sets[2])
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.near_duplicates(docs).collect()}
    low = 1 if both >= 0.8 else 2  # rows that share an id are one document to the links
    assert got == {(1, 96): 1, (3, 97): 1, (2, 96): low, (2, 4): low}


def test_near_duplicates_of_nothing_and_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, None)], "doc_id long, text string")
    assert sorted(map(str, jaccard.near_duplicates(docs).collect())) == sorted(
        map(str, [*[spark.createDataFrame([(None, 2, None)], "doc_id long, n_shingles long, component_id long").first()] * 2,
                  spark.createDataFrame([(3, 0, 3)], "doc_id long, n_shingles long, component_id long").first()])
    )
    assert jaccard.near_duplicates(docs.where("false")).count() == 0


@pytest.mark.parametrize("shape", ["path", "star", "rings"])
def test_components(spark, shape):
    edges = {
        "path": [(i, i + 1) for i in range(100, 160)],
        "star": [(i, 500) for i in range(30)],
        "rings": [(10 * k + i, 10 * k + (i + 1) % 10) for k in range(4) for i in range(10)],
    }[shape]
    got = {r.v: r.label for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {"path": lambda v: 100, "star": lambda v: 0, "rings": lambda v: v // 10 * 10}[shape]
    assert got == {v: low(v) for e in edges for v in e}


def plain_marks(rows, least=50):
    data = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in data:
        for s in range(len(b) - least + 1):
            w = b[s : s + least]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, b in data:
        hit = np.zeros(len(b), bool)
        for s in range(len(b) - least + 1):
            if first[b[s : s + least]] < i:
                hit[s : s + least] = True
        out.append((i, len(b), bytes(np.frombuffer(b, np.uint8)[~hit])))
    return sorted(out)


def test_marks_are_those_of_all_windows(spark, monkeypatch):
    rows = corpus()
    rows += [(500, "ab" * 300), (501, "xx" + "ab" * 100), (20, rows[3][1]), (20, "é" * 60), (600, "é" * 61 + "z")]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, slot int, kept string")
    for slot, bucket, part in ((4 << 20, 300_000, 1 << 20), (3000, 40, 700)):
        monkeypatch.setattr(repeats, "PART_BYTES", part)
        monkeypatch.setattr(repeats, "INDEX_BYTES", part)
        monkeypatch.setattr(repeats, "SLOT_BYTES", slot)
        monkeypatch.setattr(repeats, "BUCKET_ANCHORS", bucket)
        got = repeats.mark_repeats(docs.repartition(3), carry=["slot", "kept"]).toPandas()
        found = sorted((r[1], r[2], r[4]) for r in got.itertuples())
        assert found == plain_marks(rows)
        assert list(got.columns)[4:] == ["slot", "kept"] and set(got.iloc[:, 5]) == {"k"}
    assert repeats.mark_repeats(docs.where("false")).count() == 0


def test_a_common_line_in_different_texts(spark, monkeypatch):
    rng = random.Random(21)
    line = "all rights reserved, see terms"
    texts = [f"{' '.join(words(rng, 12))} {line} {' '.join(words(rng, 12))}" for _ in range(3000)]
    texts += [f"{t[20:]} {rng.random()}" for t in rng.sample(texts, 60)] + [texts[5], (line + " ") * 9]
    rows = [((7 * k) % 3061 if k < 3061 else k, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = plain_marks(rows)

    def counted(data, offsets, size, owner, lead, found=repeats._earlier):
        if len(lead) > 120:
            raise ValueError(f"{len(lead)} fragments in one index")
        return found(data, offsets, size, owner, lead)

    monkeypatch.setattr(repeats, "_earlier", counted)
    monkeypatch.setattr(repeats, "INDEX_BYTES", 1 << 10)
    monkeypatch.setattr(repeats, "MOST_FRAGMENTS", 100)
    for slot, bucket in ((4 << 20, 300_000), (30_000, 2000)):
        monkeypatch.setattr(repeats, "SLOT_BYTES", slot)
        monkeypatch.setattr(repeats, "BUCKET_ANCHORS", bucket)
        got = repeats.mark_repeats(docs.repartition(3)).toPandas()
        assert sorted((r[1], r[2], bytes(r[4])) for r in got.itertuples()) == wanted


def test_short_shared_passages_need_no_index(spark, monkeypatch):
    rng = random.Random(22)
    shared = [" ".join(words(rng, 9))[:34] for _ in range(12)]
    texts = [" ".join(f"{rng.random()} {p} {rng.random()}" for p in rng.sample(shared, 6)) for _ in range(60)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def counted(data, offsets, size, owner, lead, found=repeats._earlier):
        if len(lead):
            raise ValueError(f"{len(lead)} fragments in an index")
        return found(data, offsets, size, owner, lead)

    monkeypatch.setattr(repeats, "_earlier", counted)
    got = repeats.mark_repeats(docs).toPandas()
    assert sorted((r[1], r[2], bytes(r[4])) for r in got.itertuples()) == plain_marks(rows)


@pytest.mark.parametrize("around", [1, 4, 7, 35])
def test_related_fragments_are_those_that_may_share_a_window(monkeypatch, around):
    rng = random.Random(around)
    monkeypatch.setattr(repeats, "AROUND", around)
    core = bytes(rng.randrange(256) for _ in range(84))
    parts = []
    for _ in range(40):
        left, right = rng.randrange(35), rng.randrange(50, 85)
        own = bytes(rng.randrange(256) for _ in range(84))
        parts.append((own[:left] + core[left:right] + own[right:], 34))
    data = np.frombuffer(b"".join(p for p, _ in parts), np.uint8)
    sizes = np.array([len(p) for p, _ in parts])
    got = repeats._related(data, np.cumsum(sizes) - sizes, sizes, np.array([at for _, at in parts]))
    for k, (own, _) in enumerate(parts):
        others = [p for j, (p, _) in enumerate(parts) if j != k]
        if any(own[i : i + 50] == p[i : i + 50] for p in others for i in range(35)):
            assert got[k]
        elif around == 1:
            assert not got[k]


def test_marks_without_ids(spark):
    text = "0123456789" * 9
    docs = spark.createDataFrame([(None, text), (1, text), (2, text + "!")], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in repeats.mark_repeats(docs).collect()}
    assert got == {None: text.encode(), 1: text.encode(), 2: b"!"}


def test_run_index_finds_what_is_there():
    rng = np.random.default_rng(0)
    for _ in range(40):
        least, wide = int(rng.integers(1, 8)), int(rng.integers(1, 4))
        own = [bytes(rng.integers(97, 97 + wide, rng.integers(0, 25)).astype(np.uint8)) for _ in range(rng.integers(1, 12))]
        asked = [bytes(rng.integers(97, 98 + wide, rng.integers(0, 25)).astype(np.uint8)) for _ in range(8)] + own
        owners = rng.integers(0, 50, len(own))

        def flat(parts):
            return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

        data, offsets = flat(asked)
        got = RunIndex(*flat(own), owners, least).first_owners(data, offsets)
        want = np.full(len(data), NOWHERE)
        for p, at in zip(asked, offsets):
            for i in range(len(p) - least + 1):
                having = [o for o, f in zip(owners, own) if p[i : i + least] in f]
                want[at + i] = min(having, default=NOWHERE)
        assert (got == want).all()


def edited(rng, item, k):
    out = list(item)
    for _ in range(k):
        kind, at = rng.randrange(3), rng.randrange(len(out))
        if kind == 0:
            out[at] = "zz" + words(rng, 1)[0]
        elif kind == 1:
            out.insert(at, words(rng, 1)[0])
        elif len(out) > 1:
            del out[at]
    return out


def plain_distance(a, b):
    """Least edit distance of ``a`` to a stretch of ``b``."""
    now = np.arange(len(a) + 1)
    best = now[-1]
    for w in b:
        new = np.zeros_like(now)
        for i, x in enumerate(a, 1):
            new[i] = min(now[i - 1] + (x != w), now[i] + 1, new[i - 1] + 1)
        now = new
        best = min(best, now[-1])
    return int(best)


def test_edit_distance_is_the_plain_one():
    rng = np.random.default_rng(4)
    items = rng.integers(1, 5, (30, 12)).astype(np.uint64)
    sizes = rng.integers(0, 13, 30)
    items[np.arange(12) >= sizes[:, None]] = 0
    texts = rng.integers(1, 5, (30, 20)).astype(np.uint64)
    got, _ = decontam.edit_distance(items, sizes, texts, True)
    assert list(got) == [plain_distance(list(i[:n]), list(t)) for i, n, t in zip(items, sizes, texts)]


def test_recall_at_the_threshold_and_no_false_match():
    rng = random.Random(8)
    items = [words(rng, rng.randint(8, 60)) for _ in range(120)]
    index = decontam.Index.of(list(range(120)), [" ".join(i) for i in items])
    found = planted = 0
    for n in range(240):
        item = items[n % 120]
        k = int(index.edits(len(item)))
        passage = edited(rng, item, k)
        text = " ".join(words(rng, 40) + passage + words(rng, 40))
        data = np.frombuffer(text.upper().replace(" ", ", ").encode(), np.uint8)
        got = index.search(data, np.array([0, len(data)]))
        planted += 1
        found += any(g[1] == n % 120 for g in got)
        for _, which, distance, size, a, b in got:
            assert distance == plain_distance(items[which], text.split()) <= size - -(-80 * size // 100)
            assert 0 <= a < b <= len(data)
    assert found >= 0.95 * planted


def word_list(text):
    """Words of a text, as the bytes that each lies in."""
    data = np.frombuffer(text.encode(), np.uint8)
    _, starts, ends, _ = decontam.word_hashes(data, np.array([0, len(data)]))
    return [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]


@pytest.mark.parametrize("size", [8, 60, 250, 500, 1000])
def test_recall_of_long_items_at_the_threshold(size):
    rng = random.Random(size)
    items, texts = [], []
    for _ in range(40):
        own = ["".join(words(rng, 2)) + str(rng.randrange(10**6)) for _ in range(size)]
        items.append(" ".join(own))
        for at in sorted(rng.sample(range(size), size // 5), reverse=True):
            kind, new = rng.randrange(3), f"new{rng.randrange(10**9)}"
            own[at : at + 1] = [[], [new], [new, own[at]]][kind]
        around = [" ".join(words(rng, 20)) for _ in range(2)]
        texts.append(f"{around[0]} {' '.join(own)} {around[1]}")
    index = decontam.Index.of(list(range(40)), items)
    data, bounds = decontam.utf8(pa.array(texts))
    found = {(m[0], m[1]) for m in index.search(data, bounds)}
    assert sum((k, k) in found for k in range(40)) >= 38


def test_words_by_unicode_class():
    assert word_list("“Straße” – l’été\u00a0nu…") == ["Straße", "l", "été", "nu"]
    assert word_list("e\u0301te\u0301 \u2764\ufe0f x") == ["e\u0301te\u0301", "x"]
    assert word_list("漢字kana。カナ") == ["漢", "字", "kana", "カ", "ナ"]
    assert word_list("ที่นี่ 12") == ["ที่", "นี่", "12"]
    assert word_list("한국 사람") == ["한국", "사람"]
    for a, b in (("straße", "STRASSE"), ("λόγος", "ΛΌΓΟΣ"), ("ﬁn été", "FIN ÉTÉ"), ("ñandú", "ÑANDÚ")):
        of = [decontam.word_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] for t in (a, b)]
        assert list(of[0]) == list(of[1])


def test_recall_of_upper_cased_accents_curly_quotes_and_dashes():
    rng = random.Random(18)
    accents = str.maketrans("aeiou", "áéîöü")
    items = [[w.translate(accents) + "ß" * (k % 2) for k, w in enumerate(words(rng, rng.randint(8, 60)))] for _ in range(60)]
    items += [list("".join(rng.choices("山川日月火水木金土人口手足目耳天地中大小", k=40))) for _ in range(10)]
    index = decontam.Index.of(list(range(70)), [" ".join(i) if n < 60 else "".join(i) for n, i in enumerate(items)])
    found = 0
    for n, item in enumerate(items):
        passage = edited(rng, item, int(index.edits(len(item)))) if n < 60 else item
        joined = "—".join(passage) if n % 2 else "”\u00a0“".join(passage)
        data = np.frombuffer(f"“Ça, {joined if n < 60 else '，'.join(passage)}” – fin".upper().encode(), np.uint8)
        got = index.search(data, np.array([0, len(data)]))
        found += any(g[1] == n and (n < 60 or g[2] == 0) for g in got)
    assert found >= 0.95 * len(items)


def test_decontamination_cases(spark):
    rng = random.Random(9)
    item = " ".join(words(rng, 25))
    docs = spark.createDataFrame(
        [(1, f"{' '.join(words(rng, 50))} {item}", 0), (2, " ".join(words(rng, 80)), 0), (None, item.upper(), 0), (4, None, 0), (5, "", 0)],
        "doc_id long, text string, item_id int",
    )
    items = spark.createDataFrame([(7, item), (8, item), (9, None), (10, ""), (11, "!!")], "item_id long, text string")
    got = sorted(str((r.doc_id, r.item_id, r.distance)) for r in decontam.find(docs, items).collect())
    assert got == sorted(str((d, i, 0)) for d in (1, None) for i in (7, 8))
    by_block = decontam.find(docs, items, block_bytes=10).collect()
    assert sorted(str((r.doc_id, r.item_id, r.distance)) for r in by_block) == got
    assert decontam.find(docs, items.where("false")).count() == 0
    assert decontam.find(docs.where("false"), items).count() == 0
    index = next(decontam.indexes(items))
    left = docs.where(~decontam.contaminated(docs.text, index)).select("doc_id").collect()
    assert sorted(r.doc_id for r in left) == [2, 4, 5]


def test_decontamination_searches_little_at_a_time(spark):
    class Watched:
        def search(self, data, bounds):
            if len(data) > 1 << 20:
                raise ValueError(f"{len(data)} bytes at a time")
            return []

    docs = spark.range(1, 400, 1, 1).select(F.rpad(F.col("id").cast("string"), 8192, "x").alias("text"))
    assert docs.where(~decontam.contaminated(docs.text, Watched())).count() == 399


def test_words_do_not_cross_texts():
    column = pa.array(["ab", None, "", "c d", "é"])
    assert [len(s) for s in jaccard.token_sets(column)] == [1, 0, 0, 1, 1]


def test_pipeline(spark, tmp_path):
    rows = corpus()
    rng = random.Random(12)
    item = " ".join(words(rng, 30))
    rows += [(300, f"{' '.join(words(rng, 90))} {item} {' '.join(words(rng, 30))}")]
    rows += [(400 + k, "!! ".join(["BUY", "NOW"] * (30 + k))) for k in range(40)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(
        [(i, int(i < 400), 0) for i, _ in rows], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{tmp_path}/labels.parquet")
    at, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path)).cache()
        seen[name] = {r.doc_id for r in at.select("doc_id").collect()}
        if name != "packing":
            assert at.columns == docs.columns
    good, distinct, fresh, clean, packed = seen.values()
    assert good == {i for i, _ in rows if i < 400}
    classes = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs.where("doc_id < 400")).collect()}
    assert distinct == {i for i in good if classes[i] == i}
    left = {i: (n, kept) for i, n, kept in plain_marks([r for r in rows if r[0] in distinct])}
    assert fresh == {i for i, (n, kept) in left.items() if kept or not n}
    assert clean == fresh - {300} and packed == clean
    whole = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").sum("length").collect()
    assert {r[0] for r in whole} == packed
