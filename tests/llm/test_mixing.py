from collections import defaultdict

import pytest

from lexwarrant.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Reshare by weight until nothing is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        rest = total - sum(held.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return held | share
        held |= {s: cap * sizes[s] for s in over}


def sizes_of(rows):
    out = defaultdict(int)
    for r in rows:
        out[r[3]] += len((r[1] or "").replace(" ", "x").replace(" ", "x").split())
    return dict(out)


def verify(df, rows, **more):
    got = mixing.mix(df, **more).collect()
    assert len(got) == len(rows)
    sizes = sizes_of(rows)
    targets = brute_targets(sizes) if sum(sizes.values()) else {}
    by_target, taken, largest = {}, defaultdict(int), defaultdict(int)
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["taken"] <= 3 * r["size"]
        key = (r["source_size"], round(r["target"], 5))
        taken[key] += r["taken"]
        largest[key] = max(largest[key], r["size"])
        by_target[key] = 1
    assert {(sizes[s], round(t, 5)) for s, t in targets.items()} >= {k for k in by_target if k[0]}
    return taken, largest


def test_supplied_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    taken, largest = verify(df, rows)
    for (_, target), n in taken.items():
        assert abs(n - target) <= largest[_, target] / 2 + 1


@pytest.mark.parametrize("chunk", [4, 128])
def test_levels_of_the_tree(documents, chunk):
    rows = [(i, "w " * (1 + i % 37), "x", "abc"[i % 3 if i % 2 else 0], 1) for i in range(900)]
    taken, largest = verify(documents(rows), rows, chunk=chunk)
    for key, n in taken.items():
        assert abs(n - key[1]) <= largest[key] / 2 + 1


def test_reruns_agree_however_rows_are_dealt(documents):
    rows = [(i, "w " * (1 + i % 11), "x", "ab"[i % 2], 1) for i in range(300)]
    key = lambda df: sorted((r["doc_id"], r["taken"]) for r in mixing.mix(df).collect())
    assert key(documents(rows)) == key(documents(rows[::-1]).repartition(7))


def test_expected_copies(documents):
    """Over many seeds a document is taken as often as its source's share says."""
    rows = [(i, "w " * (3 + i % 5), "x", "abc"[i % 3], 1) for i in range(60)]
    total, target, n = defaultdict(int), {}, 12
    for seed in range(n):
        for r in mixing.mix(documents(rows), seed=seed).collect():
            total[rows[r["doc_id"]][3]] += r["taken"]
            target[rows[r["doc_id"]][3]] = r["target"]
    assert all(abs(total[s] / n - target[s]) < 4 for s in total)


def test_targets_stop_at_the_cap(documents):
    rows = [(1, "w " * 4, "x", "a", 1), (2, "w " * 1000, "x", "b", 1), (3, "w " * 3, "x", "c", 1), (4, "w " * 50, "x", None, 1)]
    got = {r["doc_id"]: r["target"] for r in mixing.mix(documents(rows)).collect()}
    expected = brute_targets({"a": 4, "b": 1000, "c": 3, None: 50})
    assert got == pytest.approx({1: expected["a"], 2: expected["b"], 3: expected["c"], 4: expected[None]})


def test_odd_rows(odd):
    verify(odd, odd.rows)
    rows = mixing.mixed_documents(odd)
    assert rows.columns == odd.columns
    copies = sum(r["copies"] for r in mixing.mix(odd).collect())
    assert rows.count() == copies


def test_main_path_is_native(sample):
    plan = mixing.mix(sample)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def folded(rows, level, chunks, last, settled):
    """One level by plain loops: the documents that remain of each chunk."""
    from hashlib import md5

    number = lambda *parts: int(md5(":".join(map(str, parts)).encode()).hexdigest()[:12], 16) / 2**48
    groups = {}
    for r in rows:
        key = (mixing.SEED, level, r["doc_id"], r["size"])
        r = {**r, "u": number(*key)}
        groups.setdefault(int(number("chunk", *key) * chunks), []).append(r)
    left = []
    for chunk in groups.values():
        chunk.sort(key=lambda r: (r["u"], r["doc_id"]))
        a = dict(chunk[0])
        for b in map(dict, chunk[1:]):
            sa, sb = float(a["size"]), float(b["size"])
            up, down = min(1 - a["p"], b["p"] * sb / sa), min(a["p"], (1 - b["p"]) * sb / sa)
            rise = a["u"] * (up + down) < down
            if up == 1 - a["p"] if rise else down == a["p"]:
                b["p"] = max(0.0, min(1.0, b["p"] - up * sa / sb if rise else b["p"] + down * sa / sb))
                settled[a["doc_id"]] = 1 if rise else 0
                a = b
            else:
                a["p"] = max(0.0, min(1.0, a["p"] + up if rise else a["p"] - down))
                a["u"] = b["u"]
                settled[b["doc_id"]] = 0 if rise else 1
        if last:
            settled[a["doc_id"]] = int(a["p"] >= 0.5)
        else:
            left.append(a)
    return left


@pytest.mark.parametrize("chunk", [4, 9])
def test_the_tree_by_brute_force(spark, chunk):
    """Chunks far smaller than a source, so that there are levels of the tree, document by document."""
    import math

    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r for r in mixing.mix(df, chunk=chunk).collect()}
    sources = {r["doc_id"]: r["source"] for r in df.collect()}
    by_source = {}
    for i, r in got.items():
        share = r["target"] / r["source_size"]
        whole = math.floor(share)
        by_source.setdefault(sources[i], []).append({"doc_id": i, "size": r["size"], "whole": whole, "p": share - whole})
    assert max(map(len, by_source.values())) > chunk
    rest = {s: [r for r in rows if r["size"] > 0 and r["p"] > 1e-12] for s, rows in by_source.items()}
    # the first level counts all documents of a source, later ones those that are left
    counts = {s: len(rows) for s, rows in by_source.items()}
    settled, level, held = {}, 0, max(counts.values())
    while True:
        last = held <= chunk
        for s, rows in rest.items():
            left = folded(rows, level, 1 if last else max(1, math.ceil(counts[s] / chunk)), last, settled) if rows else []
            settled.update({r["doc_id"]: int(r["p"]) for r in left if r["p"] in (0, 1)})
            rest[s] = [r for r in left if 0 < r["p"] < 1]
        if last:
            break
        counts = {s: len(rows) for s, rows in rest.items()}
        held, level = max(counts.values()), level + 1
    assert level >= 1
    for rows in by_source.values():
        for r in rows:
            copies = 1 if not r["size"] else r["whole"] + settled.get(r["doc_id"], 0)
            assert got[r["doc_id"]]["taken"] == copies * r["size"], r
