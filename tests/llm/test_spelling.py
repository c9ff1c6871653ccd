import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tellurion.llm import spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(rows, noise=199):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    kept = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in kept if one_edit(w, v)] for w in kept}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-kept[v], v), default=None)
        form[word] = best if best and kept[best] >= 5 * kept[word] else None
    found = set()
    for word, n in kept.items():
        root = word
        while form[root]:
            root = form[root]
        found.add((word, form[word], root, n, len(near[word]), kept.get(form[word])))
    return found


def edited(word, rng):
    i, c = rng.randrange(len(word)), rng.choice("abcdeéß")
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :]])


def test_forms_and_roots_are_those_of_all_pairs(spark):
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdeéß", k=rng.randint(6, 9))) for _ in range(25)]
    words += ["aaaaaa", "aaaaaaa", "bananas", "bananaé", "thing" * 30, "x" * 3000, "x" * 3001]
    weights = {w: rng.choice([5, 30, 200]) for w in words}
    for word in list(weights):
        for _ in range(3):
            weights.setdefault(edited(word, rng), rng.choice([1, 5, 6, 40]))
    weights |= {"chaina": 5, "chainab": 25, "chainabc": 125, "chainabcd": 700, "tiesaa": 30, "tiesab": 30, "tiesac": 6}
    flat = [w.upper() if k % 3 == 0 and w.isascii() else w for k, w in enumerate(w for w, n in weights.items() for _ in range(n))]
    rng.shuffle(flat)
    rows = [(i if i % 9 else None, " ".join(flat[i::40]) + "; × 3÷4\nß") for i in range(40)]
    rows += [(50, None), (51, ""), (3, "chaina chaina"), (3, "chaina chaina")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("n")).repartition(3)
    for noise in (199, 3):
        got = spelling.variants(docs, noise=noise).collect()
        want = plain(rows, noise)
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert spelling.variants(docs.where("false")).count() == 0


def test_no_table_of_words_is_broadcast(spark, monkeypatch):
    plans = []

    def watched(frame, name, write=spelling.staged):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return write(frame, name)

    monkeypatch.setattr(spelling, "staged", watched)
    docs = spark.createDataFrame([(k, "planet planets planed garden gardens " * 9) for k in range(9)], "doc_id long, text string")
    found = spelling.variants(docs)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert found.count() > 0
    assert any("SortMergeJoin" in p for p in plans)
    assert not any("Broadcast" in p for p in plans)


def test_neighbourhood_is_every_one_edit_string():
    rng = np.random.default_rng(4)
    points = rng.integers(97, 123, (5, 6))
    same, longer = spelling.Reduced(points, 6), spelling.Reduced(points, 7)
    for method, reduced, size in (("same", same, same.size), ("longer", longer, longer.size)):
        rows, keys = getattr(reduced, method)()
        for k in range(len(points)):
            own = reduced.symbols[k].tolist()
            if method == "same":
                strings = {tuple(own[:i] + [c] + own[i + 1 :]) for i in range(6) for c in range(size)}
            else:
                strings = {tuple(own[:i] + [c] + own[i:]) for i in range(7) for c in range(size)}
            values, power = reduced.values, reduced.power
            want = {int(reduced._keys((values[list(s)] * power[: len(s)]).sum()[None])[0]) for s in strings}
            assert sorted(want) == sorted(keys[rows == k].tolist())
