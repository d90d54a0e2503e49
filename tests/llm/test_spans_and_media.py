import hashlib
import random
import re
import string
import tarfile
import time
import zlib

import pytest
from pyspark.sql import functions as F

from lexwarrant.llm import fingerprints as P, media as M, secret_scan as S


def edited(text, after):
    k = len(text) // 2
    return text[: len(text) - k] + after[:k]


def brute_sketch(text):
    """Distinct spans, to compare what estimates stand for."""
    n = min(P.SPAN, len(text))
    return {text[i : i + n] for i in range(len(text) - n + 1)} if text else set()


def test_span_hashes_and_extensions():
    rnd = random.Random(1)
    a, b = ("".join(rnd.choice("ab𝔘é") for _ in range(300)) for _ in range(2))
    ha, hb = P.PrefixHashes.of(a), P.PrefixHashes.of(b)
    for _ in range(300):
        i, j, n = rnd.randrange(280), rnd.randrange(280), rnd.randrange(0, 9)
        assert (ha.span(i, i + n) == hb.span(j, j + n)) == (a[i : i + n] == b[j : j + n])
        k = 0
        while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
            k += 1
        assert ha.common_extension(i, hb, j) == k
    joined = ha.joined(120, hb, 77)
    whole = P.PrefixHashes.of(a[:120] + b[:77])
    assert all((x == y).all() for x, y in zip(joined.sums, whole.sums))
    assert P.PrefixHashes.of("").fingerprint(P.PrefixHashes.of("").sketch()) == "0.0000000000000000."


@pytest.mark.parametrize("ranges", [1, 7])
def test_fingerprints(spark, sample, monkeypatch, ranges):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        got = {r["doc_id"]: r for r in P.fingerprint_documents(sample).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    ids = sorted(sample.texts, reverse=True)
    assert set(got) == set(ids)
    of = {}
    for k, i in enumerate(ids):
        text, after = sample.texts[i], sample.texts[ids[(k + 1) % len(ids)]]
        r, e = got[i], edited(text, after)
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(e.encode()).hexdigest())
        assert of.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        h = P.PrefixHashes.of(e)
        assert r["edited_fingerprint"] == h.fingerprint(h.sketch())
        n = next((x for x, (c, d) in enumerate(zip(text, after)) if c != d), min(len(text), len(after)))
        assert r["common_next"] == n
        for other, near in ((e, r["near_edited"]), (after, r["near_next"])):
            a, b = brute_sketch(text), brute_sketch(other)
            assert abs(near - 2 * len(a & b) / (len(a) + len(b))) < 0.25
    assert len(set(of.values())) == len(of)


def test_fingerprints_of_odd_rows(odd):
    got = P.fingerprint_documents(odd).collect()
    assert len(got) == len(odd.rows)
    rows = sorted(odd.rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] is not None, r[1] or "")))
    expected = []
    for k, r in enumerate(rows):
        text, after = r[1] or "", rows[(k + 1) % len(rows)][1] or ""
        expected.append((r[0] or -1, hashlib.sha256(edited(text, after).encode()).hexdigest()))
    assert sorted((r["doc_id"] or -1, r["edited_sha256"]) for r in got) == sorted(expected)


def test_one_document_follows_itself(documents):
    (r,) = P.fingerprint_documents(documents([(1, "abcdef", "", "", 6)])).collect()
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()


def plain_spans(text):
    """The three patterns as they are written, failing matches dropped afterwards."""
    out = []
    for kind, pattern, group, least in (
        (0, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12), (1, r"AKIA[A-Z0-9]+", 0, 18), (2, r"[0-9a-f]+", 0, 16),
    ):
        for m in re.finditer(pattern, text, re.I | re.A if kind == 0 else 0):
            if len(m[group]) >= least:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_of_supplied_documents(sample):
    got = {r["doc_id"]: r for r in S.scan_documents(sample).collect()}
    for i, text in sample.texts.items():
        base = plain_spans(text)
        said = ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert got[i]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (got[i]["n_assign"], got[i]["n_access"], got[i]["n_hex"]) == tuple(sum(k == j for _, k, _ in base) for j in range(3))
        assert set(filter(None, said.split(","))) <= set(got[i]["spans"].split(","))


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("Password: 'abcdefghijkl' x", ["assign"]), ("secret: token: abcdefghijklmnop", []), ("API_KEY=short", []), ("ſecret=abcdefghijklmnop", []),
        ("é AKIAABCDEFGHIJ1234", ["access"]), ("AKIA1234", []), ("0123456789abcdef 0123456789abcde", ["hex"]),
        ("use ghp_a8Kq2ZxV91LmPw07TbRy5NcD3sUe now", ["random"]), ("id 550e8400-e29b-41d4-a716-446655440000", []), ("sum DA39A3EE5E6B4B0D3255BFEF95601890AFD80709 ok", ["random"]), ("sha1: DA39A3EE5E6B4B0D3255BFEF95601890AFD80709 ok", []), ("at etc/Digest=DA39A3EE5E6B4B0D3255BFEF95601890AFD80709 ok", []),
        ("see section_12-of_the-annual_report-2021 there", []), ("internationalization and misunderstandings", []), ("call 12345678901234567890", ["hex"]), ("", []),
    ],
)
def test_kinds(text, kinds):
    base = S.base_spans(text)
    assert base == plain_spans(text)
    more = S.random_spans(text, base, S.token_efficiency())
    assert [S.KINDS[k] for _, k, _ in sorted(base + more)] == kinds


def plain_stretches(lengths):
    """(first, last) tokens of the stretches with the highest sums: the highest of all sums, the shortest of equal
    ones and the first of those, then the same on either side."""
    sums, best = [0.0], None
    for n in lengths:
        sums.append(sums[-1] + 1.5 - n)
    for i in range(len(lengths)):
        for j in range(i + 1, len(lengths) + 1):
            if sums[j] - sums[i] > 0 and (best is None or (sums[j] - sums[i], i - j) > (best[0], best[1] - best[2])):
                best = (sums[j] - sums[i], i, j)
    if best is None:
        return []
    _, i, j = best
    return plain_stretches(lengths[:i]) + [(i, j)] + [(a + j, b + j) for a, b in plain_stretches(lengths[j:])]


def plain_spans_of(run, before, lengths_of):
    """(start, end) of a run's random stretches as they are stated."""

    def told(x, said):
        bare = x
        for name in ("sha1", "sha224", "sha256", "sha384", "sha512", "md5"):
            if x.startswith(name):
                bare = x[len(name) :].lstrip("-_=.:")
        says = bare != x or re.search("(sha-?[0-9]*|md5|digest|checksum|hash|commit|revision|etag|integrity|fingerprint)[^a-z0-9]{0,4}$", said.lower())
        groups = x.split("-")
        uuid = [len(g) for g in groups] == [8, 4, 4, 4, 12] and all(c in string.hexdigits for g in groups for c in g)
        return uuid or (says and bare and all(c in string.hexdigits for c in bare) and len(bare) in (32, 40, 56, 64, 96, 128))

    def whole(x, said):
        if len(x) < 16 or not any(c.isalpha() for c in x) or told(x, said):
            return False
        one = lambda p: not p or p.isdigit() or (p.isalpha() and (p.isupper() or p[1:].islower() or (len(p) == 1)))
        parts = re.split(r"[-_./=+]", x)
        x = "".join(parts) if len(parts) > 1 and all(map(one, parts)) else x
        return len(x) <= 2 * len(lengths_of(x))

    def pieces(x, signs):
        at = 0
        for piece in re.split(f"([{signs}])", x):
            if piece and piece not in signs:
                yield at, piece
            at += len(piece)

    said = lambda at: (before + run[:at])[-24:]
    if not any(told(x, said(at)) for at, x in pieces(run, "/=")) and whole(run, before):
        return [(0, len(run))]
    if told(run, before):
        return []
    out = []
    for at, segment in pieces(run, "/="):
        if whole(segment, said(at)):
            out.append((at, at + len(segment)))
        elif not told(segment, said(at)):
            for off, part in pieces(segment, "_.+-"):
                begin = at + off
                if whole(part, said(begin)):
                    out.append((begin, begin + len(part)))
                elif len(part) >= 20 and any(c.isalpha() for c in part) and not told(part, said(begin)):
                    n = lengths_of(part)
                    ends = [sum(n[:k]) for k in range(len(n) + 1)]
                    out += [(begin + ends[i], begin + ends[j]) for i, j in plain_stretches(n) if ends[j] - ends[i] >= 20]
    return out


def plain_random(text, base, lengths_of):
    """Random stretches of runs, which are found character by character."""
    chars, found, i = set(string.ascii_letters + string.digits + "_+/=.-"), [], 0
    while i < len(text):
        j = i
        while j < len(text) and text[j] in chars:
            j += 1
        run = text[i:j]
        while run and run[-1] in ".-=":
            run = run[:-1]
        if j - i >= 16 and not any(s < i + len(run) and i < e for s, _, e in base):
            found += [(i + s, 3, i + e) for s, e in plain_spans_of(run, text[max(0, i - 24) : i], lengths_of)]
        i = max(j, i + 1)
    return found


FOUND_IN = {
    "path": "static/assets/images/production/2024/reports/{24}", "within a path": "static/assets/2024/quarterly/internal/{24}/index.html", "two words": "{a12}-{a12}", "letters": "{a24}",
    "capital digits": "{X32}", "dots": "{20}.{20}.{20}", "after a name": "service_account_{24}", "key": "v1/{24}={24}", "glued": "applicationconfiguration{48}",
}


@pytest.mark.parametrize("form", FOUND_IN)
def test_random_parts_are_found_where_they_stand(form):
    rnd, scan, found = random.Random(3), S.token_efficiency(), 0
    letters = {"": string.ascii_letters + string.digits, "a": string.ascii_lowercase, "X": "0123456789ABCDEF"}
    for _ in range(200):
        text = "use " + re.sub(r"\{([aX]?)(\d+)\}", lambda m: "".join(rnd.choice(letters[m[1]]) for _ in range(int(m[2]))), FOUND_IN[form]) + " now"
        found += bool(S.random_spans(text, S.base_spans(text), scan))
    assert found >= 180


def test_names_and_paths_are_no_secrets():
    scan = S.token_efficiency()
    for text in ("static/assets/images/production/2024/reports/summary.html", "see https://example.org/a/b-c/article_number-12/index.html?page=2", "src/main/java/org/example/service/AccountServiceImplementation.java", "release-candidate_version-1.2.3", "user.name+filter@example"):
        assert S.random_spans(text, S.base_spans(text), scan) == [], text


def test_random_spans_by_brute_force(sample):
    scan = S.token_efficiency()
    rnd = random.Random(6)
    made = ["".join(rnd.choice(string.ascii_letters + string.digits + "-_./=+ ") for _ in range(400)) for _ in range(100)]
    made += ["/".join("".join(rnd.choice(["".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(rnd.randrange(3, 30))), "configuration", "report", "_", "-"]) for _ in range(rnd.randrange(1, 5))) for _ in range(3)) for _ in range(300)]
    made += ["sha256-" + "ab12" * 16, "x" * 40 + " Sun_light-2020.html/Index_page", "550e8400-e29b-41d4-a716-446655440000 q" * 3]
    for text in [*sample.texts.values(), *made]:
        base = S.base_spans(text)
        assert S.random_spans(text, base, scan) == plain_random(text, base, scan.lengths)


@pytest.mark.parametrize("text", ["=" * 300_000, "a" * 300_000, "0123456789abcdef" * 18_750, "kQ" * 150_000, "secret" + " " * 300_000, "token=abcdefghijklmnop " * 13_000])
def test_long_runs_take_little_time(text):
    began = time.time()
    base = S.base_spans(text)
    S.random_spans(text, base, S.token_efficiency())
    assert time.time() - began < 3


def test_secrets_of_odd_rows(odd):
    got = S.scan_documents(odd).collect()
    assert len(got) == len(odd.rows)
    assert all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() and r["spans"] == "" for r in got)


def check_media(got, rows):
    assert len(got) == len(rows)
    expected = []
    for i, text in rows:
        p = (text or "").encode()
        n = len(p)
        p += b"\xff" * (max(1, -(-n // 576)) * 576 - n)
        expected.append((i or -1, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(p) // 576))
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["height"]) for r in got) == sorted(expected)
    equal = {}
    for r in got:
        assert equal.setdefault(r["payload_sha256"], (r["media_bytes"], r["media_sha256"], r["feature"])) == (r["media_bytes"], r["media_sha256"], r["feature"])


def test_media(sample):
    check_media(M.media_columns(sample, shard_bytes=50_000).collect(), sample.texts.items())


def test_media_of_odd_rows(odd):
    check_media(M.media_columns(odd).collect(), [r[:2] for r in odd.rows])


def test_one_copy_a_digest_over_all_tasks(documents, tmp_path):
    """The feature by plain arithmetic, too, and every place readable in the folder that stays."""
    rows = [(i, f"text {i % 5} " * 60, "", "", 1) for i in range(40)] + [(3, "text 3 " * 60, "", "", 1), (None, "text 4 " * 60, "", "", 1), (None, "null " * 200, "", "", 1), (None, "null " * 200, "", "", 1)]
    got = M.media_columns(documents(rows).repartition(4), f"file://{tmp_path}/kept").collect()
    check_media(got, [r[:2] for r in rows])
    places, members = {}, 0
    for r in got:
        assert places.setdefault(r["payload_sha256"], (r["shard"], r["offset"], r["length"])) == (r["shard"], r["offset"], r["length"])
        with open(tmp_path / "kept" / r["shard"], "rb") as f:
            f.seek(r["offset"])
            payload = M.decode_image(f.read(r["length"]))
        assert hashlib.sha256(payload).hexdigest() == r["payload_sha256"]
        k = len(payload) // 64
        means = [sum(payload[j * k : j * k + k]) / k for j in range(64)]
        mean = sum(payload) / len(payload)
        bits = "".join(str(int(m > sum(means) / 64)) for m in means)
        deviation = (sum((x - mean) ** 2 for x in payload) / len(payload)) ** 0.5
        assert r["feature"] == f"{int(bits, 2):016x}:{mean:.4f}:{deviation:.4f}"
    for shard in (tmp_path / "kept").glob("*.tar"):
        with tarfile.open(shard) as tar:
            members += len(tar.getnames())
    assert members - len(places) <= 2  # rows of one id and text, and of null ids, may be stored each


def test_shards_are_tar_files_addressed_by_content(spark, documents, tmp_path):
    rows = [(i, f"text {i % 3}" * 40, "", "", 1) for i in range(9)]
    folder = f"file://{tmp_path}/shards"
    docs = documents(rows).withColumn("digest", M.digest_of_payload(F.col("text")))
    index = M.store(docs.coalesce(1), folder)
    found = index.collect()
    assert len({(r["digest"], r["offset"]) for r in found}) == 3
    with tarfile.open(next((tmp_path / "shards").glob("*.tar"))) as tar:
        names = tar.getnames()
        assert sorted(names) == sorted({f"{r['digest']}.png" for r in found})
        for name in names:
            assert hashlib.sha256(M.decode_image(tar.extractfile(name).read())).hexdigest() == name[:-4]
    meta = M.with_metadata(spark.createDataFrame(found, index.schema), folder).collect()
    assert {(r["width"], r["bits"]) for r in meta} == {(576, 8)}
    with pytest.raises(ValueError):
        M.read_header(b"nothing of the kind" * 3)
