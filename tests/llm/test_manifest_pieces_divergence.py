"""Pieces against the library, divergence and manifest against brute force, and their odd inputs."""

import hashlib
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tabwright.llm import divergence, merkle, pieces, queries
from tabwright.llm.common import offsets
from tabwright.llm.token_counts import VOCABULARY

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, grp string, pos long, term string, ids string, decoded string"


def docs_of(spark, rows):
    """(doc_id, text, lang, source) with columns whose names the operators use themselves."""
    full = [(i, t, lang, source, len(t or ""), "g", 1, "t", "x", "y") for i, t, lang, source in rows]
    return spark.createDataFrame(full, DOCS)


ODD = [
    (None, "a b c", "en", "s"), (1, None, None, None), (2, "", "", ""), (3, " \n\t ", "en", None), (4, "One", None, "s"),
    (5, "Same TEXT", "en", "s"), (5, "Same TEXT", "en", "s"), (6, "x" * 50_000, "en", "s"), (7, "Lang " * 5_000, "fr", "é"),
    (5, "Same text", "en", "s"), (-8, "ÉÀ A", "en", "z"),
]

# --- pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(Path(VOCABULARY).read_bytes())


def test_merge_rounds_equal_the_library(model, library):
    rng = random.Random(1)
    alphabets = ["abc ", "aeiou nrst", "▁ a", "the and of ing ", " \n\t=-_*#/", "éèà aux ", "日本語の東京 ", "0123456789 .,", "😀👍🏽 a‍", "\x00<s>ﬁ\xa0"]
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 200))) for a in alphabets for _ in range(400)]
    texts += [" " * n + "5" for n in range(80)] + [" " * n + "the" for n in range(80)] + ["a" * 999, " " * 100_000, "<0x41><unk>", "  a  b "]
    at, ids = model.encode(texts)
    assert [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))] == library.encode(texts)
    assert model.decode(at, ids) == [library.decode(x) for x in library.encode(texts)]


def test_decoding_any_ids_equals_the_library(model, library):
    rng = random.Random(2)
    pick = [lambda: rng.randrange(32_000), lambda: rng.randrange(259), lambda: rng.randrange(3), lambda: 259, lambda: 28705]
    lists = [[rng.choice(pick)() for _ in range(rng.randint(0, 12))] for _ in range(5_000)]
    flat = np.array([i for x in lists for i in x], dtype=np.int32)
    assert model.decode(offsets([len(x) for x in lists]), flat) == [library.decode(x) for x in lists]


def test_forgetting_words_changes_nothing(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "HELD_CHARS", 50)
    monkeypatch.setattr(pieces, "ROUND_CHARS", 20)
    texts = [f"word{i} other{i % 7} " * 5 for i in range(50)]
    for k in range(0, 50, 5):
        at, ids = model.encode(texts[k : k + 5])
        assert [ids[at[i] : at[i + 1]].tolist() for i in range(5)] == library.encode(texts[k : k + 5])
    model._forget()


def test_pieces_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op11_pieces(spark, FOLDER).collect()}

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()

    want = {}
    for r in docs:
        ids = library.encode(r.text or "")
        want[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    assert got == want


def test_pieces_take_odd_rows_and_keep_columns(spark, library):
    docs = docs_of(spark, ODD)
    out = pieces.decode(pieces.encode(docs, VOCABULARY), VOCABULARY)
    assert set(out.columns) == set(docs.columns) and dict(out.dtypes)["ids"] == "array<int>"
    rows = out.collect()
    assert sorted((r.text or "", r.ids) for r in rows) == sorted((t or "", library.encode(t or "")) for _, t, _, _ in ODD)
    assert all(r.decoded == (r.text or "") and r.grp == "g" for r in rows)
    assert pieces.decode(pieces.encode(docs.where("false"), VOCABULARY), VOCABULARY).count() == 0
    nothing = out.select("doc_id", F.lit(None).cast("array<int>").alias("ids"))
    assert {r.decoded for r in pieces.decode(nothing, VOCABULARY).collect()} == {""}


# --- divergence


def brute_divergence(rows, opts):
    def terms(text):
        out, now = [], ""
        for c in text + " ":
            if c.isascii() and not c.isalpha():
                out, now = out + [now] * bool(now), ""
            else:
                now += c.lower() if c.isascii() else c
        return out

    rows = [(lang or "", source or "", terms(text or "")) for text, lang, source in rows]
    result = set()
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        df = Counter(t for r in mine for t in set(r[2]))
        kept = sorted((t for t in df if df[t] >= opts.min_docs), key=str.encode)
        n = {s: Counter(t for r in mine if r[1] == s for t in r[2] if df[t] >= opts.min_docs) for s in {r[1] for r in mine}}
        n[None] = sum(n.values(), Counter())
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept} for s, c in n.items()}

        def f(s, o, t):
            return (p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t])

        for s in n.keys() - {None}:
            pairs = sorted(((-sum(f(s, o, t) for t in kept), o.encode(), o) for o in n.keys() - {s, None}))
            result |= {(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pairs)}
            over = sorted((-f(s, None, t), t.encode(), t) for t in kept if n[s][t] and p[s][t] > p[None][t])
            result |= {(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(over[: opts.top_terms])}
    return result


@pytest.mark.parametrize("postings,held", [(400_000, 400_000), (40, 30)])
def test_divergence_equals_brute_force(spark, postings, held):
    rng = random.Random(3)
    vocab = [a + b for a in "abcdéfghij" for b in "klmnöpqrst"]
    rows = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else f"s{i % 7}"
        own = vocab[(i % 7) * 8 :][:40]
        rows.append((i, " ".join(rng.choice(own).title() for _ in range(rng.randint(0, 40))), rng.choice(["en", "fr", None]), source))
    rows += [(900, None, "de", "a"), (901, "rare words", "de", "b"), (902, "1234 -- ", "en", "bare"), *ODD]
    opts = divergence.AuditOptions(slice_postings=postings, held_terms=held)
    got = divergence.divergence(docs_of(spark, rows), opts).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == brute_divergence([r[1:] for r in rows], opts)
    assert {r.value for r in got if r.lang == "de"} == {0}


def test_row_accumulation_in_small_chunks():
    rng = np.random.default_rng(4)
    seen = rng.random((12, 60)) < 0.3
    seen[0] = True
    source, term = np.nonzero(seen)
    p, none = rng.integers(1, 10**9, len(source)), rng.integers(1, 10**6, 12)
    whole = dict(divergence.accumulated(source, term, p, none[source]))
    small = dict(divergence.accumulated(source, term, p, none[source], chunk=5))
    share = {(s, t): int(x) for s, t, x in zip(source, term, p)}

    def f(a, b):
        return (a - b) ** 2 // (a + b)

    for a in range(12):
        for b in range(12):
            shared = [t for t in range(60) if a != b and seen[a, t] and seen[b, t]]
            a0, b0 = int(none[a]), int(none[b])
            want = sum(f(share[a, t], share[b, t]) - f(share[a, t], b0) - f(a0, share[b, t]) + f(a0, b0) for t in shared)
            assert whole[a][b] == small[a][b] == want


def test_divergence_of_nothing(spark):
    assert divergence.divergence(docs_of(spark, ODD).where("false")).count() == 0


# --- manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(nodes):
    if len(nodes) == 1:
        return nodes[0], [[]]
    runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
    root, above = brute_tree([digest(*r) for r in runs])
    return root, [[(r[:k], r[k + 1 :]), *above[j]] for j, r in enumerate(runs) for k in range(len(r))]


def brute_manifest(rows):
    def leaf(r, text):
        values = (r.doc_id, r.source, r.lang, r.n_chars, text)
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
    trees = []
    for source in sorted(by_source, key=lambda s: (s is not None, (s or "").encode())):
        held = sorted(by_source[source], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        trees.append((held, *brute_tree([leaf(r, r.text) for r in held])))
    root, tops = brute_tree([t[1] for t in trees])
    out = []
    for (held, subroot, below), top in zip(trees, tops):
        for r, steps in zip(held, below):
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None
            node = leaf(r, "".join(c.lower() if c.isascii() else c for c in r.text) if hit else r.text)
            for before, after in steps + top:
                node = digest(*before, node, *after)
            proof = digest(*[d for before, after in steps + top for d in before + after])
            out.append((str(r.doc_id), leaf(r, r.text), subroot, root, proof, node, node == root))
    return sorted(out)


def flat(df):
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect())


@pytest.mark.parametrize("height", [1, merkle.HEIGHT])
def test_manifest_equals_brute_force(spark, height):
    rows = [(i * 7 - 300, f"Text {i}", "en", "hot" if i % 3 == 0 else f"s{i % 5}") for i in range(900)]
    rows += [(5000 + i, "T", "en", f"only{i}") for i in range(20)] + ODD
    docs = docs_of(spark, rows)
    got = flat(merkle.checked(docs, height))
    assert got == brute_manifest(docs.collect())
    assert 100 < sum(not r[-1] for r in got) < 300


def test_manifest_of_few_rows(spark):
    assert merkle.checked(docs_of(spark, ODD).where("false")).count() == 0
    one = docs_of(spark, ODD[5:6])
    row = merkle.manifest(one).first()
    assert row.leaf == row.subroot == row.root and row.steps == []
    assert flat(merkle.checked(one)) == brute_manifest(one.collect())


@pytest.mark.parametrize("n", [*range(1, 40), 255, 256, 257, 4095, 4096])
def test_open_tree_extends_witnesses(n):
    leaves = [digest(str(i)) for i in range(n)]
    tree = merkle.OpenTree()
    for i, d in enumerate(leaves):
        tree.append(str(i), d)
    root, runs = tree.finish(None)
    want, witnesses = brute_tree(leaves)
    assert root == want and [d for r in runs for d in r.digests] == leaves
    for run, first in zip(runs, range(0, n, 16)):
        assert run.steps == [("".join(a), "".join(b)) for a, b in witnesses[first][1:]]
        assert len(run.steps) == len(runs[0].steps)
