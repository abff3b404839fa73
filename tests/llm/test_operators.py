"""Training-data operators against brute force, round trips and held-out accuracy on small inputs."""

import gzip
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabwright.llm import decontaminate, fingerprint, maxent, neardup, packing, pii, quality, queries, token_counts, toxicity, warc
from tabwright.llm.common import words
from tabwright.llm.components import components

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, key string"


def docs_of(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, "k") for i, t in rows], DOCS)


ODD = [(None, "a b c d e f"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Same text here"), (5, "Same text here"),
       (6, "x" * 50_000), (7, "lang " * 5_000), (8, "Same text here")]


# --- archives


def test_archives_round_trip_and_revisits(spark):
    big = "<p>" + "é" * 800 + "</p>"
    rows = [(1, "u1", big), (2, "u2", big), (3, None, None), (4, "u\r\n4", "short"), (5, "u5", "short"), (None, "u", big), (2, "u2", big)]
    out = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == len(rows) and all(r.gap is None for r in out)
    digest = hashlib.sha1(big.encode()).hexdigest()
    kinds = sorted((r.record_id.split(":")[2], r.record_type, r.payload_bytes) for r in out if r.payload_digest == digest)
    size = len(big.encode())
    assert kinds == [("1", "revisit", size), ("2", "response", size), ("2", "response", size), ("null", "revisit", size)]
    assert {bytes(r.payload) for r in out if r.record_id.startswith("<urn:page:4")} == {b"short"}


def test_archives_are_cut_at_their_size(spark):
    opts = warc.WarcOptions(row_bytes=4000, archive_bytes=40_000, out_bytes=10_000)
    noise = {i: random.Random(i).randbytes(500 if i % 10 else 30_000).hex() for i in range(200)}
    rows = [(i, None if i % 3 else f"http://x/{i}", noise[i], "extra") for i in noise]
    path = warc.archived(spark.createDataFrame(rows, "page_id long, url string, html string, payload string").coalesce(1), opts)
    sizes = [r.length for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("length").collect()]
    longest = max(len(warc.member(warc.record_bytes(i, "http://x/0", html.encode(), None))) for i, html in noise.items())
    assert len(sizes) >= sum(sizes) / (40_000 + longest) and max(sizes) <= 40_000 + longest + 10 and len(sizes) > 10
    back = {r.record_id.split(":")[2]: bytes(r.payload).decode() for r in warc.read_archives(spark, path, opts).collect()}
    assert back == {str(i): html for i, html in noise.items()}
    records, gaps = warc.indexed(spark, path, opts)
    assert records.count() == 200 and gaps.count() == 0


def test_gaps_are_kept_as_a_table(spark, tmp_path):
    units = [warc.member(warc.record_bytes(i, "u", b"payload %d " % i * 50, None)) for i in range(6)]
    bad = bytearray(units[2])
    bad[len(bad) // 2] ^= 255
    (tmp_path / "part-0.warc.gz").write_bytes(b"".join([*units[:2], bytes(bad), *units[3:]]))
    records, gaps = warc.indexed(spark, str(tmp_path))
    assert records.count() == 5 and "gap" not in records.columns
    gap = gaps.collect()
    start = len(units[0]) + len(units[1])
    assert [(r.offset, r.end_offset) for r in gap] == [(start, start + len(bad))] and gap[0].gap


def test_no_pages_give_no_records(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    records, gaps = warc.indexed(spark, warc.archived(none))
    assert records.count() == gaps.count() == 0


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_goes_on_after_damage(packed):
    records = [warc.record_bytes(i, "u", (b"payload %d " % i) * 50, None) for i in range(6)]
    units = [warc.member(r) if packed else r for r in records]
    starts = np.cumsum([0, *map(len, units)])
    data = bytearray(b"".join(units))
    data[starts[1] + len(units[1]) // 2] ^= 0xFF
    data[starts[3] : starts[3] + 3] = b"???"
    got = list(warc.salvage(bytes(data)))
    ids = [int(f["record_id"].split(":")[2]) for _, _, gap, f in got if gap is None]
    assert ids == [0, 2, 4, 5]
    assert [(s, e) for s, e, gap, _ in got if gap] == [(starts[1], starts[2]), (starts[3], starts[4])]
    assert sum(e - s for s, e, _, _ in got) == len(data)
    cut = list(warc.salvage(b"".join(units)[:-7]))
    assert len([1 for *_, gap, f in cut if gap is None]) == 5 and cut[-1][2]


def test_salvage_inside_a_member_of_several_records():
    records = [warc.record_bytes(i, "u", random.Random(i).randbytes(3000), None) for i in range(6)]

    def ids(data):
        got = list(warc.salvage(data))
        return [int(f["record_id"].split(":")[2]) for *_, gap, f in got if gap is None], [g for *_, g, _ in got if g]

    spoilt = bytearray(b"".join(records))
    start = len(records[0]) + len(records[1])
    spoilt[start + len(records[2]) - 100] ^= 0xFF
    found, gaps = ids(gzip.compress(bytes(spoilt), 6))
    assert found == [0, 1, 3, 4, 5] and len(gaps) == 1 and f"{start}-{start + len(records[2])}" in gaps[0]
    whole, after = gzip.compress(b"".join(records), 6), warc.member(warc.record_bytes(9, "u", b"x", None))
    found, gaps = ids(whole[: len(whole) // 2])
    assert found == [0, 1] and len(gaps) == 1
    for level in (0, 6):  # stored blocks show plain records, which must not come twice
        damaged = bytearray(gzip.compress(b"".join(records), level))
        damaged[len(damaged) * 7 // 12] ^= 0xFF
        found, gaps = ids(bytes(damaged) + after)
        assert found[:3] == [0, 1, 2] and 3 not in found and found[-1] == 9 and len(found) == len(set(found)) and gaps
    assert ids(whole + after) == ([0, 1, 2, 3, 4, 5, 9], [])


def test_members_are_plain_gzip():
    record = warc.record_bytes(1, "u", b"x" * 2000, None)
    assert gzip.decompress(warc.member(record) + b"\0\0" + warc.member(record)) == record * 2


# --- near copies


def brute_components(rows, size, percent=80):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w)} if 0 < len(w) < size else {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * len(sets[a] | sets[b]):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_components_match_brute_force(spark, size):
    rng = random.Random(size)
    vocab = [f"w{k}" for k in range(400)]
    rows = []
    for group in range(12):
        base = rng.choices(vocab, k=rng.choice([1, 3, 12, 60, 150]))
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 8)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(copy)))
    got = neardup.near_duplicates(docs_of(spark, rows), neardup.MinHashOptions(shingle=size, block=4))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(rows, size)


def test_odd_documents_are_kept_apart(spark):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs_of(spark, ODD), neardup.MinHashOptions(shingle=2)).collect()}
    assert (None, 5, None, False) in got and (1, 0, 1, True) in got and (3, 0, 3, True) in got
    assert (5, 2, 5, True) in got and (8, 2, 5, False) in got and (7, 1, 7, True) in got


def test_signature_is_one_shifted_permutation():
    x = np.arange(1, 3000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = neardup.signature(x[:2000], 128), neardup.signature(x[500:2500], 128)
    assert abs((a == b).mean() - 1500 / 2500) < 0.15
    assert (neardup.signature(x[:700], 128, 16) == neardup.signature(x[:700], 128)).all()


def test_star_contraction_on_a_long_chain(spark):
    edges = [(i + 1, i) for i in range(60)] + [(101, 100), (100, 101), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


# --- counts, fingerprints, packing


def test_counts_match_plain_segmentation():
    rng = random.Random(1)
    scores = {"".join(rng.choices("abc", k=rng.randint(1, 4))): -rng.random() * 5 for _ in range(40)}

    def best(word):
        table = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            options = [(table[end - 1][0] + token_counts.BYTE_SCORE, table[end - 1][1] - 1)]
            options += [(table[s][0] + scores[word[s:end]], table[s][1] - 1) for s in range(end) if word[s:end] in scores]
            table.append(max(options))
        return -table[-1][1]

    found = ["".join(rng.choices("abcd", k=rng.randint(1, 12))) for _ in range(300)]
    trie = token_counts.CountTrie(scores)
    assert trie.counts(found) == {w: best(w) for w in found}
    assert trie.nodes < sum(map(len, set(found)))


def test_token_counts_of_odd_documents(spark):
    got = {(r.doc_id, r.n_words): r.n_tokens for r in token_counts.count_tokens(docs_of(spark, ODD)).collect()}
    assert got[1, 0] == 0 and got[3, 0] == 0 and got[7, 5000] % 5000 == 0 and got[6, 1] > 100


def test_fingerprints(spark):
    rows = [(1, "a b.\nc d.\ne"), (2, "e\na b.\nc d."), (3, None), (4, "z. y. x."), (9, "a b.\nc d.\ne")]
    got = {r.doc_id: r for r in fingerprint.edited_fingerprints(docs_of(spark, rows)).collect()}
    assert got[1].fingerprint == got[2].fingerprint == got[9].fingerprint != got[4].fingerprint
    assert got[3].n_chars == 0 and got[3].near_edited == 1.0 and got[2].near_next == 1.0
    texts = {i: t or "" for i, t in rows}
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        t, n = texts[i], texts[order[(k + 1) % len(order)]]
        m = len(t) // 3
        edited = t[: len(t) - m] + n[:m]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    odd = fingerprint.edited_fingerprints(docs_of(spark, ODD)).collect()
    assert len(odd) == len(ODD) and all(0 <= r.near_next <= 1 for r in odd)
    assert fingerprint.edited_fingerprints(docs_of(spark, [])).count() == 0


def test_paragraphs_can_be_put_in_and_taken_out(spark):
    df = spark.createDataFrame([("a b.\nc", "x y\nz.", "z.\na b.\nx y\nc")], "p string, q string, all string")
    for name, prefix in (("p", "p_"), ("q", "q_"), ("all", "all_")):
        df = fingerprint.with_lanes(df, name, prefix)
    df = fingerprint.deleted(fingerprint.inserted(df, "p_", "q_", "sum_"), "sum_", "p_", "back_")
    row = df.select(*[fingerprint.rendered(p).alias(p) for p in ("sum_", "all_", "back_", "q_")]).first()
    assert row["sum_"] == row["all_"] and row["back_"] == row["q_"]


def test_bounds_have_the_least_padding():
    from itertools import combinations

    rng = np.random.default_rng(2)
    lengths = np.sort(rng.choice(np.arange(1, 60), 9, replace=False))
    counts = rng.integers(1, 30, 9)

    def padding(bounds):
        return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))

    for k in (1, 3, 4):
        least = min(padding([*c, lengths[-1]]) for c in combinations(lengths[:-1], k - 1))
        assert padding(packing.bucket_bounds(lengths, counts, k)) == least


def test_batches_hold_every_piece_once(spark):
    opts = packing.PackOptions(max_length=64, n_buckets=4, token_budget=256, rows_per_task=7)
    got = packing.packed(docs_of(spark, ODD), opts).collect()
    lengths = {i: 1 + len(words(t)) for i, t in ODD}
    assert sum(r.length for r in got) == sum(1 + len(words(t)) for _, t in ODD)
    assert all(r.length <= r.bound <= 64 and r.start + r.length <= lengths[r.doc_id] for r in got)
    sizes = {}
    for r in got:
        sizes.setdefault((r.bucket, r.bound), {}).setdefault(r.batch, []).append(r)
    for (_, bound), batches in sizes.items():
        full = max(1, 256 // bound)
        assert sorted(batches) == list(range(len(batches)))
        assert all(len(b) == full for k, b in batches.items() if k < len(batches) - 1)
    assert packing.packed(docs_of(spark, []), opts).count() == 0


# --- leaks, personal data, models


def test_leaks_match_plain_search(spark):
    rng = random.Random(3)
    vocab = [f"v{k}" for k in range(300)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.randint(3, 40)))) for k in range(60)] + [(60, None), (61, "")]
    rows = []
    for i in range(80):
        body = rng.choices(vocab, k=rng.choice([5, 100, 400]))
        if i % 3 == 0:
            at = rng.randrange(len(body))
            body[at:at] = rng.choice(items[:60])[1].upper().split()
        rows.append((i, " ".join(body)))
    frame = spark.createDataFrame(items, "item_id long, text string")
    opts = decontaminate.Bm25Options()
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs_of(spark, rows + ODD), frame, opts).collect()}
    want = set()
    for k, item in items[:60]:
        w = decontaminate.plain_words(item)
        halves = [w[: (len(w) + 1) // 2], w[(len(w) + 1) // 2 :]]
        for i, text in rows:
            t = decontaminate.plain_words(text)
            shares = []
            for h in halves:
                s = decontaminate.shingles(h, 5)
                size = len(next(iter(s)))
                shares.append(len(s & decontaminate.shingles(t, size)) / len(s))
            if min(shares) >= 0.8 and len(w) >= 10:
                want.add((i, k))
    assert want <= got and {i for i, _ in got} >= {i for i in range(0, 80, 3)}
    clean = decontaminate.without_leaks(docs_of(spark, rows + ODD), frame, opts)
    bad = {i for i, _ in got}
    assert clean.columns == DOCS.replace(",", "").split()[::2]
    assert sorted(r.doc_id for r in clean.collect() if r.doc_id is not None and r.doc_id > 8) == [i for i in range(9, 80) if i not in bad]


def test_leaks_of_templated_items_in_several_indexes(spark):
    rng = random.Random(17)
    common = [f"t{k}" for k in range(30)]
    items = []
    for k in range(90):
        w = common[:8] + [f"rare{k}", f"odd{k % 40}", f"more{k % 45}"] + common[8:22] + [f"last{k}x{j}" for j in range(3)] + common[22:]
        items.append((k, " ".join(w)))
    frame = spark.createDataFrame(items, "item_id long, text string")
    docs = []
    for k, text in items:
        w = text.split()
        w[-11:-8] = ["gone", "gone", "gone"] if k % 2 else w[-11:-8]
        docs.append((k, " ".join(rng.choices(common, k=40) + w + rng.choices(common, k=40))))
    whole = decontaminate.Bm25Options(min_overlap=0.3)
    parts = decontaminate.Bm25Options(min_overlap=0.3, index_bytes=3000)
    got = [
        {(r.doc_id, r.item_id): round(r.bm25_share, 9) for r in decontaminate.retrieved(docs_of(spark, docs), frame, o).collect()}
        for o in (whole, parts)
    ]
    assert got[0] == got[1] and min(got[0].values()) < 0.5
    plain = [(k, decontaminate.plain_words(t)) for k, t in items]
    stats, o = decontaminate.item_stats(plain), whole
    idf = {t: np.log(1 + (stats.n - c + 0.5) / (c + 0.5)) for t, c in stats.df.items()}
    for k, w in plain:
        norm = o.k1 * (1 - o.b + o.b * len(w) * stats.n / stats.n_words)
        raw = {t: idf[t] * w.count(t) * (o.k1 + 1) / (w.count(t) + norm) for t in set(w)}
        for i, text in docs:
            share = sum(v for t, v in raw.items() if t in set(decontaminate.plain_words(text))) / sum(raw.values())
            assert (share >= 0.4) == ((i, k) in got[0]), (i, k, share)


def test_base_patterns():
    text = "x a.b@c-d.org, 1.2.3.4, 999.1.1.1, 4111 1111 1111 1111, 4111111111111112, +1 (988) 555-2485 q@r"
    found = [(k, text[s:e]) for k, s, e in pii.base_spans(text)]
    assert found == [("email", "a.b@c-d.org"), ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (988) 555-2485")]
    import re

    plain = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    rng = random.Random(4)
    for _ in range(3000):
        t = "".join(rng.choices("aB0.@@-_ +", k=14))
        assert pii._emails(t) == [m.span() for m in plain.finditer(t)]
    plain_ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        t = "".join(rng.choices("12...", k=14))
        assert [m.span() for m in pii._IP.finditer(t)] == [m.span() for m in plain_ip.finditer(t)]


def test_field_keeps_base_spans_and_adds_distant_repeats(spark):
    rng = random.Random(5)
    rows = []
    for i in range(120):
        phone = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        rows.append((i, f"call {phone} now. version 2.{i % 9}. mail u{i}@mail{i % 9}.example.com or item {i} there"))
    docs = docs_of(spark, rows + ODD)
    got = pii.digest(docs).collect()
    assert len(got) == len(rows) + len(ODD)
    by_id = {r.doc_id: r for r in got}
    for i, t in rows:
        base = pii.joined(pii.base_spans(t))
        if i not in {d for d, _ in ODD}:
            assert by_id[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and by_id[i].n_phone == 1
            assert set(base.split(",")) <= set(by_id[i].spans.split(","))
    clean = pii.redact(docs)
    assert clean.where("text LIKE '%555-%' OR text LIKE '%@%'").count() == 0 and clean.columns == docs.columns
    # Loopy messages keep a tree exact: a pair of nodes against enumeration.
    field = pii.SkipChainField(np.zeros((pii._BUCKETS, 5)), np.zeros((5, 5)), np.eye(5) * 2.0)
    field.unary[1] = [0, 3, 0, 0, 0]
    nodes = pii.Nodes([(0, 1), (5, 6)], [[1], [2]], [], [(0, 1)], [0, 0])
    joint = np.exp(field.unary[1][:, None] + field.unary[2][None] + field.skip)
    belief = field.beliefs([nodes], 40)
    assert np.allclose(belief[1], joint.sum(axis=0) / joint.sum(), atol=1e-6)


def test_repeats_behind_plain_words_are_added(spark):
    rng = random.Random(15)
    rows, more = [], {}
    for i in range(160):
        area, line = rng.randint(200, 999), rng.randint(1000, 9999)
        clear, compact = f"+1 ({area}) 555-{line}", f"{area}555{line}"
        first, last = (clear, compact) if i % 2 else (compact, clear)
        text = f"call {first} today or the same at {last} then"
        rows.append((i, text if i < 40 else f"call {clear} today with order {rng.randint(10**9, 10**10 - 1)} then"))
        more[i] = i < 40 and f"phone:{text.index(compact)}:{text.index(compact) + 10}"
    got = {r.doc_id: r.spans.split(",") for r in pii.digest(docs_of(spark, rows)).collect()}
    assert all(len(s) == 2 and more[i] in s if more[i] else len(s) == 1 for i, s in got.items())
    assert pii.nodes_of("x 4711 and 4711", []).skip == [(0, 1)] and pii.nodes_of("x 4711 4711", []).skip == []
    text = "mail a1@b.example.org and 1234567 or 1234567, so"
    nodes = pii.nodes_of(text, pii.base_spans(text))
    back = pii._unpacked(pii._packed(nodes))
    assert [back.features, back.chain, back.skip, back.labels, back.tied] == [nodes.features, nodes.chain, nodes.skip, nodes.labels, nodes.tied]


def labelled(spark, bad, good, n=400):
    rows = [(i, (bad if i % 4 == 0 else good)(i)) for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), int(i % 4 == 0)) for i in range(n)], "doc_id long, quality int, toxic int")
    return rows, labels


def test_toxic_words_are_found_with_letters_put_in(spark):
    rng = random.Random(6)
    plain = ["".join(rng.choices("aeioultrn", k=rng.randint(2, 9))) for _ in range(300)]
    insults = ["grubbox", "snivpark", "muckwhif"]
    rows, labels = labelled(
        spark, lambda i: " ".join(rng.choices(plain, k=30) + [rng.choice(insults)]) + ". Fine.", lambda i: " ".join(rng.choices(plain, k=31)) + "."
    )
    extra = [(1000, "you g.r.u.b.b.o.x there"), (1001, "a snivxpark sits"), (1002, "quite a m u c k w h i f is"), (1003, "good day to all")]
    out = toxicity.scored(docs_of(spark, rows + extra + ODD), labels).select("doc_id", "toxic_score").collect()
    score = {r.doc_id: r.toxic_score for r in out}
    assert len(out) == len(rows) + len(extra) + len(ODD) and all(0 <= s <= 1 for s in score.values())
    assert np.mean([(score[i] >= 0.7) == (i % 4 == 0) for i, _ in rows if i > 8]) > 0.98
    assert min(score[1000], score[1001], score[1002]) >= 0.7 > score[1003]


def test_insults_are_found_at_any_share_and_beside_copies(spark):
    rng = random.Random(16)
    plain = ["".join(rng.choices("aeioultrn", k=rng.randint(2, 9))) for _ in range(300)]
    insults = ["grubbox", "snivpark", "muckwhif"]
    clean = [" ".join(rng.choices(plain, k=31)) for _ in range(160)]
    toxic = [" ".join(rng.choices(plain, k=30) + [insults[i % 3]]) for i in range(160)]
    copied = "zebrafish " + " ".join(f"calm{chr(97 + k % 26)}{chr(97 + k // 26)}word" for k in range(250)) + " vilegrot"
    for bad, good, shown in ((toxic, clean, "half"), (toxic[:40] + [copied] * 100, clean, "copies")):
        rows = list(enumerate(bad + good))
        labels = spark.createDataFrame([(i, 0.5, int(i < len(bad))) for i, _ in rows], "doc_id long, quality double, toxic int")
        extra = [(1000 + k, f"you {w} there") for k, w in enumerate(insults)] + [(1003, "good zebrafish to all calmaaword")]
        out = toxicity.scored(docs_of(spark, rows + extra), labels).where("doc_id >= 1000").collect()
        score = {r.doc_id: r.toxic_score for r in out}
        assert min(score[1000], score[1001], score[1002]) >= 0.7 > score[1003], shown
    none = spark.createDataFrame([(i, 0.5, i % 2) for i in range(8)], "doc_id long, quality double, toxic int")
    assert all(0 < r.toxic_score < 1 for r in toxicity.scored(docs_of(spark, [(i, "alike") for i in range(8)]), none).collect())


def test_kernel_pruning_loses_nothing():
    rng = random.Random(7)
    found = ["".join(rng.choices("abcde", k=rng.randint(1, 9))) for _ in range(300)]
    marks = toxicity.Landmarks(found[:20], toxicity.KernelOptions())
    dense = toxicity.unit_features(found, 5, 0.6) @ toxicity.unit_features(found[:20], 5, 0.6).T
    dense[dense < 0.45] = 0
    keep, rows = marks.kernel(found)
    full = np.zeros_like(dense)
    full[keep] = rows
    assert (np.abs(full - dense)[np.abs(dense - 0.45) > 1e-4] < 1e-4).all()


def test_votes_match_plain_cosines(spark):
    rng = random.Random(8)
    rows, labels = labelled(spark, lambda i: " ".join(["SPAM!!", "WIN###"] * rng.randint(3, 30)), lambda i: " ".join(rng.choices(["fine", "words", "here.", "Some"], k=40)))
    out = quality.scored(docs_of(spark, rows + ODD), labels).select("doc_id", "quality_score").collect()
    score = {r.doc_id: r.quality_score for r in out}
    assert len(out) == len(rows) + len(ODD) and np.mean([(score[i] >= 0.5) == (i % 4 != 0) for i, _ in rows if i > 8]) > 0.98
    counts = quality.term_counts([t for _, t in rows])
    y = np.array([float(i % 4 != 0) for i, _ in rows])
    voter = quality.LatentVoter.fit(counts[:200], y[:200], quality.KnnOptions(neighbours=7, block=16))
    latent, kept = voter.latent(counts[200:230]), voter.latent(counts[:200])
    for vector, vote in zip(latent, voter.vote(counts[200:230])):
        cosine = kept @ vector
        top = np.sort(cosine)[::-1][:7]
        near = cosine >= top[-1] - 1e-6
        share = y[:200][near]
        assert share.min() - 1e-6 <= vote <= share.max() + 1e-6


def test_row_sums_add_rare_and_frequent_keys():
    rng = np.random.default_rng(3)
    for n, keys in ((1, 5), (300, 2), (4000, 900), (4000, 70_000)):
        column = (rng.integers(0, keys, n) ** 2 // keys).astype(np.int32)
        values = rng.integers(-9, 9, (n, 4)).astype(np.float32)
        want = np.zeros((keys + 1, 4), dtype=np.float32)
        np.add.at(want, column, values)
        rows, sums = maxent.row_sums(column, values)
        assert sorted(rows) == sorted(set(column.tolist()))
        assert np.array_equal(sums, want[rows])


def test_language_model_is_proper_and_its_base_exact(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice([["the", "cat", "sat"], ["a", "dog", "ran"]]) * rng.randint(1, 9)) + f" rare{i % 90}") for i in range(400)]
    opts = maxent.LmOptions(frequent=20, own=5, groups=4)
    docs = docs_of(spark, rows + ODD)
    got = maxent.scored(docs, opts).collect()
    assert len(got) == len(rows) + len(ODD)
    import zlib
    from collections import Counter

    def tokens(t):
        return [*words(t), b" "]

    held = {i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2 for i in {i for i, _ in rows + ODD}}
    count = Counter(t for i, x in rows + ODD if not held[i] for t in tokens(x))
    n, v = sum(count.values()), len(count)
    want = sorted(
        ((-1 if i is None else i), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), held[i], round(sum(np.log10((count[w] + 1) / (n + v + 1)) for w in tokens(t)), 5))
        for i, t in rows + ODD
    )
    have = sorted(((-1 if r.doc_id is None else r.doc_id), r.n_tokens, r.n_known, r.held_out, round(r.base_score, 5)) for r in got)
    assert have == want and {r.train_tokens for r in got} == {n}
    own = [r for r in got if r.held_out and r.n_tokens < 100]
    assert sum(r.score for r in own) > sum(r.base_score for r in own) and all(r.score < 0 for r in got)


def test_pipeline_stages_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, kept, FOLDER).cache()
        assert now.columns == docs.columns
        ids, before = {r.doc_id for r in now.select("doc_id").collect()}, {r.doc_id for r in kept.select("doc_id").collect()}
        if name == "near_dedup":
            rows = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
            assert ids == {i for i, (_, c) in brute_components(rows, 5).items() if i == c}
        assert ids <= before and len(ids) > 0.6 * len(before)
        kept = now
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, kept, FOLDER).select("doc_id").collect()} == ids


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, stage):
    shape = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in ODD], shape)
    assert stage(spark, odd, FOLDER).count() >= 0
    assert stage(spark, odd.where(F.lit(False)), FOLDER).count() == 0


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)] and set(queries.SQL) <= set(queries.QUERIES)


def test_postings_in_chunks_and_halves_of_short_items():
    rng = random.Random(12)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, decontaminate.plain_words(" ".join(rng.choice(vocab) for _ in range(30)))) for i in range(40)]
    texts = [" ".join(rng.choice(vocab) for _ in range(900)) + " " + " ".join(w.decode() for w in items[i][1]) for i in range(20)]

    def rows(**changed):
        index = decontaminate.BlockIndex(items, decontaminate.Bm25Options(**changed))
        return sorted(index.query(list(range(20)), texts))

    assert rows() == rows(posting_chunk=1) == rows(posting_chunk=1000) and {(r[0], r[1]) for r in rows()} >= {(i, i) for i in range(20)}
    lone = decontaminate.BlockIndex([(1, [b"hello"]), (2, [b"good", b"day"])])
    got = {(r[0], r[1]): min(r[3:]) for r in lone.query([7, 8], ["she said hello to them", "a good day"])}
    assert got.get((7, 1), 0.0) == 0.0 and got[8, 2] == 1.0
