import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from lexwarrant.llm import line_templates, near_dedup
from lexwarrant.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(texts, width, needed=80):
    """Components by comparing all pairs."""
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {i: shingles(t, width) for i, t in texts.items()}
    for a, b in combinations(texts, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= needed * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in texts}, {i: len(s) for i, s in sets.items()}


def check(df, texts, width):
    found, sizes = brute(texts, width)
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(df, width).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == found
    assert {i: r["n_shingles"] for i, r in got.items()} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


@pytest.mark.parametrize("width", [4, 5])
def test_supplied_documents(sample, width):
    check(sample, sample.texts, width)


@pytest.mark.parametrize("dense", [1024, 16])
def test_families_around_the_threshold(documents, monkeypatch, dense):
    """Copies with edits of every strength, in regions searched whole and in dense ones of all levels."""
    monkeypatch.setattr(near_dedup, "DENSE", dense)
    rnd, texts = random.Random(5), {}
    for family in range(3):
        base = [f"w{rnd.randrange(500)}" for _ in range(120)]
        for k in range(50):
            w = list(base)
            for _ in range(rnd.randrange(0, 9)):
                w[rnd.randrange(len(w))] = f"x{rnd.randrange(99)}"
            texts[family * 100 + k] = " ".join(w)
    check(documents([(i, t, "en", "s", len(t)) for i, t in texts.items()]), texts, 4)


def test_odd_rows(odd):
    rows = near_dedup.near_duplicates(odd, 4).collect()
    assert len(rows) == len(odd.rows)
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in rows}
    if odd.rows:
        assert got[1, 3] == got[1, 3] == (1, True) and got[6, 3] == (1, False)
        assert got[2, 0] == (2, True) and got[3, 0] == (3, True) and got[4, 0] == (4, True)
        assert got[None, 2] == got[None, 0] == (None, True)
    kept = near_dedup.deduplicated(odd)
    assert kept.columns == odd.columns and kept.count() == len(odd.rows) - (1 if odd.rows else 0)


def test_repeated_ids_tie_their_texts(documents):
    a, b = "one two three four five six seven", "eins zwei drei vier fünf sechs"
    df = documents([(1, a, "", "", 1), (2, a, "", "", 1), (2, b, "", "", 1), (3, b, "", "", 1)])
    assert {r["component_id"] for r in near_dedup.near_duplicates(df, 4).collect()} == {1}


def test_pairs_at_the_threshold_in_dense_regions(documents, monkeypatch):
    """Recall of links that only dense regions show: partners of 0.80 to 0.83 among alike documents."""
    monkeypatch.setattr(near_dedup, "DENSE", 12)
    rnd, texts = random.Random(9), {}
    shared = [f"s{k}" for k in range(60)]  # ties all documents at about 0.3 or 0.4
    for i in range(0, 120, 2):
        own = [f"o{i}x{k}" for k in range(62)]
        w = shared + own
        texts[i] = " ".join(w)
        # one place changes four shingles: three changes among 119 give 107 / 131, or 0.817
        for k in (5, 70, 110):
            w[k] = f"z{i}{rnd.randrange(9)}"
        texts[i + 1] = " ".join(w)
    check(documents([(i, t, "en", "s", len(t)) for i, t in texts.items()]), texts, 4)


def test_half_shared_documents_stay_apart(documents, spark):
    """2,000 documents that share half their words: no links, and few candidates."""
    rnd = random.Random(3)
    shared = [f"s{k}" for k in range(100)]
    docs = documents([(i, " ".join(shared + [f"o{rnd.randrange(10**9)}" for _ in range(100)]), "en", "s", 1) for i in range(2000)])
    got = near_dedup.near_duplicates(docs, 4)
    assert got.where("component_id <> doc_id").count() == 0 and got.count() == 2000
    classes = near_dedup.signed(docs, 4).select(F.col("doc_id").alias("rep"), "signature")
    found, dense = near_dedup.candidates(near_dedup.looked_through(near_dedup.entries(classes, near_dedup.LEVELS[0]), 80), 80)
    assert found.count() < 500 and dense.count() == 0


@pytest.mark.parametrize("dense", [1024, 100])
def test_a_family_of_loose_copies_gives_no_rows_for_all_its_pairs(documents, monkeypatch, dense):
    """300 edited copies of one text, most of them alike at 0.6 to 0.78: pairs that sketches can't tell from links."""
    monkeypatch.setattr(near_dedup, "DENSE", dense)
    rnd, texts, made = random.Random(11), {}, {}
    base = [f"w{k}" for k in range(150)]
    for i in range(300):
        w = list(base)
        for _ in range(rnd.choice([1, 2, 3, 3, 4, 4, 5])):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        texts[i] = " ".join(w)
    write = near_dedup.write_table

    def counted(df, name):
        out = write(df, name)
        made.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "write_table", counted)
    check(documents([(i, t, "en", "s", len(t)) for i, t in texts.items()]), texts, 4)
    assert max(made["candidates"]) <= 32 * 300 < 300 * 299 / 4


@pytest.mark.parametrize("most", [1024, 30, 7])
def test_regions_however_ranges_cut_them(spark, monkeypatch, most):
    """Members alike by their sketches: candidates connect the groups of equal prefixes, or what has longer ones in
    common where groups are dense, and nothing else; members of dense groups are told."""
    monkeypatch.setattr(near_dedup, "DENSE", most)
    rnd = random.Random(1)
    names = ["prefix", *near_dedup._T, "rep", *near_dedup._S]
    rows = [(rnd.choice([1, 2, 3, rnd.randrange(400)]), *(rnd.randrange(3) for _ in near_dedup._T), i, 5, 5, 5, 5) for i in range(3000)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names)).repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        found, dense = near_dedup.candidates(near_dedup.looked_through(df, 80), 80)
        pairs, told = [(r["a"], r["b"]) for r in found.collect()], {(r["prefix"], r["rep"]) for r in dense.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    assert told == {(p, r[-5]) for p, g in groups.items() if len(g) > most for r in g}
    of = {r[-5]: r[0] for r in rows}
    assert all(of[a] == of[b] for a, b in pairs) and len(pairs) <= len(rows) + near_dedup.PAIRS * len(groups)
    root = {i: i for i in of}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    for group in groups.values():
        if len(group) <= most:
            assert len({find(r[-5]) for r in group}) == 1


def test_components_of_a_long_chain(spark, monkeypatch):
    from lexwarrant.llm import components as module

    written = []
    keep = module.write_table
    monkeypatch.setattr(module, "write_table", lambda df, name: (written.append(name), keep(df, name))[1])
    links = spark.range(10_000).selectExpr("id AS a", "id + 1 AS b")
    got = components(links, finish=0)
    assert got.count() == 10_001 and got.where("component <> 0").count() == 0
    assert written.count("nearest") <= 20


@pytest.mark.parametrize("finish", [0, 100, 500_000])
def test_components(spark, finish):
    rnd = random.Random(2)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(70)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), finish).collect()}
    parent = {n: n for link in links for n in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert got == {n: root(n) for n in parent if any(n in link and link[0] != link[1] for link in links)}
    assert components(spark.createDataFrame([], "a long, b long"), finish).count() == 0


def prose(rnd, n):
    return " ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(4000)}x".replace("1", "i").replace("0", "o") for _ in range(n))


def lines_by_id(df):
    return {r["doc_id"]: (r["text"] or "").split("\n") for r in line_templates.without_templates(df).collect()}


def test_templates_go_and_prose_stays(documents):
    rnd, rows = random.Random(3), []
    words = [f"wort{a}{b}" for a in "abcdefghijklmnop" for b in "abcdefghijklmnop"]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    for i in range(40):
        body = [text(30), text(30)]
        if i < 8:
            body.insert(1, f"Posted on day {i * 7} of the year by the staff")
        if i < 6:
            body.append("All rights reserved.")
        if 10 <= i < 18:  # one quarter of the line varies
            body.append("this page was last changed and checked by " + text(2) + " in our small office by the sea")
        if i == 39:
            body.append("A line of its own here.")
        rows.append((i, "\n".join(body), "de", "s", 1))
    copies = text(40) + "\n" + text(25)
    rows += [(100 + i, copies, "de", "s", 1) for i in range(12)]
    got = lines_by_id(documents(rows))
    for i, t, *_ in rows:
        gone = [x for x in t.split("\n") if x not in got[i]]
        assert len(gone) == (i < 8) + (i < 6) + (10 <= i < 18), (i, gone)


def brute_templates(texts, least=4):
    """Lines to drop as (text, number), by tuples of words, counters and exact likeness of whole texts."""
    from collections import Counter

    texts = [t or "" for t in texts]
    stretches, pairs, lines = Counter(), Counter(), {}
    for t in texts:
        for i, line in enumerate(t.split("\n")):
            words = ["<*>" if re.search("[0-9]", w) else w for w in WORD.findall(line.lower())]
            n = len(words)
            if n < 3 or set(words) == {"<*>"}:
                continue
            k = min(8, n)
            cut = [(n, words[0], p, tuple(words[n * p // k : n * (p + 1) // k])) for p in range(k)]
            cut = [c for c in cut if set(c[3]) != {"<*>"}]
            pairs.update(frozenset(cut[p : p + 2]) for p in range(0, len(cut), 2))
            lines[t, i] = (n, sum(w != "<*>" for w in words), cut)
    lines = {k: x for k, x in lines.items() if any(pairs[frozenset(x[2][p : p + 2])] >= (2 if x[1] >= 50 else least) for p in range(0, len(x[2]), 2))}
    for _, _, cut in lines.values():
        stretches.update(cut)
    documents, instances = {}, {}
    for (t, i), (n, plain, cut) in lines.items():
        needs = 2 if plain >= 50 else least
        constant = sorted((-stretches[c], c[2], c) for c in cut if stretches[c] >= needs)
        needed = max(len(cut) - (3 if n >= 12 else 1 if n >= 6 else 0), len(cut) // 2 + 1)
        for a in range(len(constant)):
            for b in range(a + 1, len(constant) + 1):
                if b - a >= needed:
                    path = frozenset(c for _, _, c in constant[a:b])
                    documents.setdefault(path, set()).add(t)
                    instances.setdefault((t, i), set()).add((path, needs))
    # classes of near copies among the texts that matter
    used = sorted({t for d in documents.values() if len(d) > 1 for t in d})
    sets = [shingles(t, 5) for t in used]
    parent = list(range(len(used)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(used)), 2):
        small, large = sorted((len(sets[a]), len(sets[b])))
        if small >= 0.5 * large and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    of = {t: root(i) for i, t in enumerate(used)}
    classes = {path: len({of.get(t, t) for t in d}) for path, d in documents.items()}
    return {key for key, paths in instances.items() if any(classes[p] >= needs for p, needs in paths)}


def test_supplied_documents_by_brute_force(spark):
    """Signatures estimate likeness, so a few texts near the bound may be classed otherwise."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = df.collect()
    drop = brute_templates([r["text"] for r in rows])
    assert len(drop) > 100
    got = {r["doc_id"]: r["text"] for r in line_templates.without_templates(df).collect()}
    expected = {r["doc_id"]: "\n".join(x for i, x in enumerate(r["text"].split("\n")) if (r["text"], i) not in drop) for r in rows}
    other = [i for i, t in expected.items() if got[i] != t]
    assert len(other) <= len(rows) // 200, other


def test_variable_words_are_fields(documents):
    """A name in a short line, and two words far apart in a longer one; the first of five and 25."""
    rnd = random.Random(12)
    words = [f"w{a}{b}" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"]
    prose = lambda rnd, n: " ".join(rnd.choice(words) for _ in range(n))
    rows = [(i, prose(rnd, 30) + f"\nuser {name} logged in from the office today\n" + prose(rnd, 20), "", "", 1) for i, name in enumerate(["anna", "bob", "carl", "dora", "emil"])]
    rows += [(10 + i, prose(rnd, 25) + f"\nthe nightly build of {prose(rnd, 1)} finished without errors on the machine called {prose(rnd, 1)} in the cellar\n" + prose(rnd, 30), "", "", 1) for i in range(25)]
    passage = prose(rnd, 60)  # long ones recur from two unrelated documents on
    rows += [(50, prose(rnd, 50) + "\n" + passage, "", "", 1), (51, passage + "\n" + prose(rnd, 44), "", "", 1)]
    got = {r["doc_id"]: r for r in line_templates.line_report(documents(rows)).collect()}
    assert all(got[r[0]]["n_dropped"] == 1 for r in rows)


def test_lines_of_odd_rows(odd):
    cleaned = line_templates.cleaned_documents(odd)
    assert cleaned.columns == odd.columns and cleaned.count() == len(odd.rows)
    assert sorted(map(str, (r["text"] for r in cleaned.collect()))) == sorted(str(r[1]) for r in odd.rows)
    assert line_templates.line_report(odd).count() == len(odd.rows)


def test_documents_that_were_only_boilerplate_go(documents):
    rnd = random.Random(1)
    rows = [(i, f"All rights reserved by us.\n{prose(rnd, 20)}", "", "", 1) for i in range(6)] + [(9, "All rights reserved by us.", "", "", 26)]
    got = line_templates.cleaned_documents(documents(rows)).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(6)) and all(r["n_chars"] == len(r["text"]) for r in got)


@pytest.mark.parametrize("chunk", [7, 40, 1 << 19])
def test_tokens_and_signatures_by_plain_loops(monkeypatch, chunk):
    import numpy as np

    from lexwarrant.llm import line_templates as L

    monkeypatch.setattr(L, "CHUNK", chunk)
    rnd = random.Random(1)
    rows = [b"".join(rnd.choice([b"ab", b"c1", b" ", b"\n", b"\t", b"\x0b", "é".encode(), b"x" * rnd.randrange(30)]) for _ in range(rnd.randrange(60))) for _ in range(200)] + [b"", b"one"]
    hashes, counts, lines = L.line_tokens(rows)
    want = [line.split() for text in rows for line in text.split(b"\n")]
    assert counts.tolist() == list(map(len, want)) and lines.tolist() == [t.count(b"\n") + 1 for t in rows]
    held = {}
    for token, h in zip((t for line in want for t in line), hashes.tolist(), strict=True):
        assert held.setdefault(token, h) == h and (h & 1) == any(48 <= b < 58 for b in token)
    assert len(set(held.values())) == len(held)
    # signatures: the least shingle of each bin, an empty bin by the next one filled
    sizes = np.array([len(t.split()) for t in rows])
    got, at = L.signatures_of(hashes, sizes), 0
    for row, n in enumerate(sizes.tolist()):
        if n == 0:
            continue
        own = hashes[at : at + n].tolist()
        at += n
        sums = [sum(x * int(p) for x, p in zip(own[i : i + L.WIDTH], L._PLACES)) for i in range(max(1, n - L.WIDTH + 1))]
        if n < L.WIDTH:
            sums[0] += n
        least = {}
        for h in L.mixed(np.array([x & (1 << 64) - 1 for x in sums], np.uint64)).tolist():
            least[h >> 57] = min(h, least.get(h >> 57, h))
        for b in range(L.BINS):
            far = next(k for k in range(L.BINS) if (b + k) % L.BINS in least)
            value = np.array([least[(b + far) % L.BINS] + far * int(L._STEP) & (1 << 64) - 1], np.uint64)
            assert got[row, b] == L.mixed(value)[0]
