import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellurion.llm import vectorcodes


def plain(rows, parts, entries, rounds):
    kept = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [
        [[math.floor(256 * c) for c in r[1][p * width : (p + 1) * width]] for p in range(parts)] for r in kept
    ]
    books = [[cut[k][p] for k in range(min(entries, len(cut)))] for p in range(parts)]

    def assigned():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p])) for p, x in enumerate(own)]
            for own in cut
        ]

    for _ in range(rounds):
        nearest = assigned()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, n in zip(cut, nearest) if n[p][1] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    out, by_label = [], {}
    for (vec, _, label), near in zip(kept, assigned()):
        error = sum(d for d, _ in near)
        by_label[label] = by_label.get(label, 0) + error
        out.append((vec, label, "".join(f"{i:02x}" for _, i in near), error))
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(map(str, ((v, c, e, by_label[label]) for v, label, c, e in out))), digest


SCHEMA = "vec_id long, embedding array<float>, label int, code string"


@pytest.mark.parametrize("most", [vectorcodes.MOST_BROADCAST, 0])
def test_codes_are_those_of_a_full_search(spark, monkeypatch, most):
    monkeypatch.setattr(vectorcodes, "MOST_BROADCAST", most)
    rng = np.random.default_rng(1)
    rows = [(int(i) * 2, rng.normal(0, 0.2, 32).round(2).tolist(), int(i) % 3) for i in range(150)]
    rows += [(301, [0.0] * 32, None), (302, [0.0] * 32, None), (None, [0.5] * 32, 1), (4, rows[2][1], 2)] + [rows[5]] * 3
    rows += [(900, None, 1), (901, [float("nan")] + [0.0] * 31, 1), (902, [float("inf")] + [0.0] * 31, 1), (-5, [None] * 32, 0)]
    rows = [(v, None if x is None else [None if c is None else float(np.float32(c)) for c in x], n) for v, x, n in rows]
    vectors = spark.createDataFrame([(*r, "own") for r in rows], SCHEMA).repartition(3)
    codes, model = vectorcodes.compress(vectors, entries=20)
    want, digest = plain(rows, 16, 20, 2)
    got = vectorcodes.label_errors(codes).select("vec_id", "code", "error", "label_error").collect()
    assert sorted(str(tuple(r)) for r in got) == want
    assert model.digest() == digest
    near = vectorcodes.decoded(got[0].code, model)
    assert near.shape == (32,)


def test_search_agrees_with_all_distances():
    rng = np.random.default_rng(2)
    for spread in (2, 40):
        entries, parts = rng.integers(-spread, spread, (64, 4)), rng.integers(-spread, spread, (3000, 4))
        which, distance = vectorcodes.Codebook(entries).nearest(parts)
        every = ((parts[:, None, :] - entries[None]) ** 2).sum(2)
        assert (which == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_odd_vectors_and_empty_tables(spark):
    rows = [(1, [0.1] * 16, 1, "c"), (2, [0.1] * 8, 1, "c"), (3, [], None, "c"), (4, [1e30] * 16, 2, "c"), (5, [0.2] * 17, 2, "c")]
    vectors = spark.createDataFrame(rows, SCHEMA)
    codes, model = vectorcodes.compress(vectors)
    got = {r.vec_id: r for r in vectorcodes.label_errors(codes).collect()}
    assert set(got) == {1, 2, 3, 4, 5} and got[1].code == "00" * 16 and got[4].error == 0
    assert all(got[k].code is None and got[k].error is None for k in (2, 3, 5))
    assert model.entries.shape == (16, 2, 1) and model.entries.max() == vectorcodes.LARGEST
    for empty in (vectors.where("false"), vectors.where("vec_id in (2, 3)"), vectors.withColumn("embedding", F.lit(None).cast("array<float>"))):
        codes, model = vectorcodes.compress(empty)
        assert vectorcodes.label_errors(codes).where("code is not null").count() == 0
        assert model.digest() == hashlib.sha256(b"").hexdigest()
