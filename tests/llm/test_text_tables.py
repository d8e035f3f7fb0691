"""Phrase mining, tokenizer alignment and nearest neighbours against brute-force versions."""

import collections
import hashlib
import os
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from platter.llm import alignment, ann, collocations, queries

DATA = "/root/testdata/sf0.001"
A_FILE, B_FILE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


# --- phrase mining ----------------------------------------------------------------------------------


def mined(rows, least, top=2000):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(upper)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(zip(*[words[i:] for i in range(k)]))
    out = []
    for lang, seen in counts.items():
        candidates = {p: a for p, a in seen.items() if len(p) > 1 and a >= least}
        inside = {
            longer[i : i + k]
            for longer, b in candidates.items()
            for k in range(2, len(longer))
            for i in range(len(longer) - k + 1)
            if 100 * b >= 80 * candidates[longer[i : i + k]]
        }
        found = []
        for p, a in candidates.items():
            if p not in inside:
                score, _, left, right = min((2000000 * a // (seen[p[:k]] + seen[p[k:]]), k, seen[p[:k]], seen[p[k:]]) for k in range(1, len(p)))
                found.append((score, a, " ".join(p), left, right))
        found.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, n, p, a, left, right, total[lang], s) for n, (s, a, p, left, right) in enumerate(found[:top], 1)]
    return sorted(out)


def mine(df, least, top=2000):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r[c] for c in names) for r in collocations.collocations(df, least, top).collect())


def test_phrases_equal_plain_version(spark):
    draw = random.Random(2)
    words, gaps = ["a", "b", "A", "é", "\x01", "x\x02", "c", "日本"], [" ", " ", "\t", "  ", ". ", ", ", "\n"]
    rows = [(draw.choice(["en", "de", None, "und"]), "".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randint(0, 80)))) for _ in range(300)]
    rows += [("en", None), ("en", ""), ("fr", " .,; "), ("xx", "the same words " * 5000)] + rows[:5]
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({"a": F.lit(1), "n": F.lit("x"), "w": F.lit(2)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # families across partitions
    try:
        assert mine(df, 5) == mined(rows, 5)
        assert mine(df, 4, top=7) == mined(rows, 4, top=7)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert mine(df.limit(0), 5) == []


def test_a_family_longer_than_a_partition(spark):
    """One first word with many continuations lies in several ranges: what is handed over completes it."""
    rows = [("en", f"hot w{k:03d} end{k:03d}") for k in range(200) for _ in range(3)]
    df = spark.createDataFrame(rows, "lang string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert mine(df, 3) == mined(rows, 3)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_slices_of_a_text_table(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 200)
    rows = [(lang, "one two three. one two") for lang in ("en", "de", "fr") for _ in range(40)]
    assert mine(spark.createDataFrame(rows, "lang string, text string"), 10) == mined(rows, 10)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_phrases_equal_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{DATA}/documents.parquet')")
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    theirs = con.sql(f"SELECT {', '.join(names)} FROM ({queries.oracle_sql()['op11_phrase_mining']})").fetchall()
    ours = [tuple(r[c] for c in names) for r in queries.op11_phrase_mining(spark, DATA).collect()]
    assert sorted(ours) == sorted(theirs) and ours


# --- alignment --------------------------------------------------------------------------------------


def aligned(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(A_FILE)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    letters = alignment._byte_letters()
    entries = {number: bytes(letters[x] for x in entry) for entry, number in a_side.get_vocab().items() if all(x in letters for x in entry)}

    def b_bytes(number):
        piece = b_side.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(number) else piece.replace("▁", " ").encode()

    made, docs = [], collections.Counter()
    for key, text in rows:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        target = (" " + (text or "")).encode()
        if not text or b"".join(entries[i] for i in a) != target or b"".join(map(b_bytes, b)) != target:
            made.append((key, None))
            continue
        groups, i, j, at_a, at_b, own_a, own_b = [], 0, 0, 0, 0, [], []
        while i < len(a) or j < len(b):
            if at_a <= at_b and i < len(a):
                at_a += len(entries[a[i]])
                own_a.append(a[i])
                i += 1
            else:
                at_b += len(b_bytes(b[j]))
                own_b.append(b[j])
                j += 1
            if at_a == at_b:
                groups.append((own_a, own_b))
                own_a, own_b = [], []
        made.append((key, (len(a), len(b), groups)))
        docs.update({(x, y) for ga, gb in groups for x in ga for y in gb})
    best = {}
    for (x, _), n in docs.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for key, own in made:
        if own is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for ga, gb in own[2] for x in ga for y in gb]
        line = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in own[2])
        out.append((key, own[0], own[1], len(own[2]), len(links), sum(docs[p] == best[p[0]] for p in links), sum(docs[p] for p in links), hashlib.sha256(line.encode()).hexdigest()))
    return sorted(out, key=repr)


def align(df, **more):
    return sorted((tuple(r) for r in alignment.align(df, A_FILE, B_FILE, P.PATTERN, **more).collect()), key=repr)


def test_alignment_equals_plain_version(spark):
    draw = random.Random(1)
    bits = ["a", "é", "日", "😀", " ", "  ", "\n", "\t", "=", "====", "</s>", "<|endoftext|>", "<0x41>", "the", "ﬁ", "\x00", "़", "x" * 50, "\r\n", "'s", "1", "▁"]
    rows = [(k, "".join(draw.choice(bits[: 22 - k % 2]) for _ in range(draw.randint(0, 60)))) for k in range(400)]
    rows += [(9000, None), (9001, ""), (9002, "= " * 4000 + "=" * 9001), (None, "hello"), (9002, "日本" * 5000), (9003, " "), (9003, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit(1), "pairs": F.lit("x"), "n": F.lit(2)})
    expected = aligned(rows)
    assert align(df) == expected and sum(r[1] > 0 for r in expected) > 200
    assert align(df, heavy=40) == expected  # most pairs by the join
    assert align(df.limit(0)) == []


def test_wide_groups_by_distinct_ids():
    """A group with more links than ``WIDE`` counts the same pairs as a narrow one."""
    a, b = np.array([5, 5, 7] * 40), np.array([1, 2] * 45)
    wide = alignment.Groups(a, np.arange(1, 121) * 3, b, np.append(np.arange(1, 90) * 4 + 1, 360))
    pairs, links = wide.pairs(10)
    expected = collections.Counter()
    for g in range(wide.count):
        for x in a[wide.ga == g]:
            for y in b[wide.gb == g]:
                expected[int(x * 10 + y)] += 1
    assert dict(zip(pairs.tolist(), links.tolist())) == expected and sum(expected.values()) == wide.links


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_alignment_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op12_tokenizer_alignment(spark, DATA).collect()), key=repr) == aligned(rows)


# --- nearest neighbours -----------------------------------------------------------------------------


def nearest(rows, k=10, every=100):
    sizes = collections.Counter()
    usable = {}
    for key, v in rows:
        if key is not None and v and not any(x is None or not np.isfinite(x) for x in v) and any(v):
            sizes[len(v)] += 1
            usable[key, tuple(x + 0.0 for x in v)] = 1
    if not usable:
        return {}
    dim = min(sizes, key=lambda s: (-sizes[s], s))
    kept = [(key, v) for key, v in usable if len(v) == dim]
    ids, raw = np.array([key for key, _ in kept]), np.array([v for _, v in kept], float)
    out = {}
    for n, (key, _) in enumerate(kept):
        if key % every == 0:
            gap = np.sqrt(np.square(raw - raw[n]).sum(axis=1))
            order = [j for j in np.lexsort((ids, gap)) if j != n][:k]
            out.setdefault(key, []).append([(int(ids[j]), float(gap[j])) for j in order])
    return {key: sorted(v) for key, v in out.items()}


def searched(df, **more):
    out = collections.defaultdict(dict)
    for r in ann.nearest_neighbours(df, F.col("id") % 100 == 0, **more).collect():
        assert r["rank"] not in out[r["query_id"]]
        out[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    return {key: [[own[n] for n in range(1, len(own) + 1)]] for key, own in out.items()}


def test_neighbours_odd_rows_and_copies(spark):
    """Copies in a large group, also of queries; small blocks cut leaves on both sides; all leaves visited: exact."""
    draw = np.random.default_rng(3)
    rows = [(k, draw.normal(size=6).round(1).tolist()) for k in range(1, 600)]
    rows += [(1000 + k, [1.0, 2.0, 0.0, 0.0, 0.0, 0.5]) for k in range(900)]
    rows += [(2000 + k, (draw.normal(size=6) * 0.01 + 3).tolist()) for k in range(301)]
    rows += rows[:50] + [(5000, None), (5100, []), (5200, [0.0] * 6), (5300, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (5400, [float("nan")] * 6), (5500, [float("inf")] + [1.0] * 5), (5600, [1.0, 2.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit(0), "v": F.lit("x"), "leaf": F.lit(1)})
    assert searched(df, recall=1.1, leaf_rows=40, block=64) == nearest(rows)
    assert searched(df.limit(0)) == {}
    few = spark.createDataFrame([(100, [1.0, 2.0]), (1, [1.0, 3.0]), (200, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert searched(few) == {100: [[(200, 0.0), (1, 1.0)]], 200: [[(100, 0.0), (1, 1.0)]]}
    assert searched(few.filter("vec_id = 100")) == {}


def test_calibrated_recall(spark):
    """Clustered vectors: few leaves are visited and at least 0.9 of the true neighbours found."""
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(60, 16)) * 4
    raw = (centres[draw.integers(60, size=6000)] + draw.normal(size=(6000, 16))).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(raw)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    expected, got = nearest(rows), searched(df, leaf_rows=50, recall=0.95)
    true = {(q, i) for q, (own,) in expected.items() for i, _ in own}
    found = {(q, i) for q, (own,) in got.items() for i, _ in own}
    assert len(found) == len(true) and len(found & true) >= 0.9 * len(true)
    tree = ann.fit_tree(raw.astype(float), 6000, 50)
    truth = [np.array([tree.assign(raw[[i]].astype(float))[0] for i, _ in expected[q][0]]) for q in sorted(expected)]
    assert ann.calibrated_visits(tree, raw[::100].astype(float), truth, 0.95) < tree.leaves / 3


def test_best_bin_first_order():
    """Every leaf once; with one level of leaves the order is that of the distances to the centres."""
    draw = np.random.default_rng(5)
    tree = ann.fit_tree(draw.normal(size=(4000, 3)), 4000, 100)
    order = list(tree.order(np.zeros(3)))
    assert sorted(order) == list(range(tree.leaves)) and tree.leaves > 16
    flat = ann.fit_tree(draw.normal(size=(400, 3)), 400, 40, least=25)
    first = {int(flat.leaf[n]): np.square(flat.centres[n]).sum() for n in range(len(flat.leaf)) if flat.leaf[n] >= 0}
    if (flat.count[0] == flat.leaves):
        assert list(flat.order(np.zeros(3))) == sorted(first, key=first.get)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_neighbours_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    got = collections.defaultdict(list)
    for r in sorted(queries.op13_nearest_neighbours(spark, DATA).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    true, found = nearest(rows), {q: {i for i, _ in own} for q, own in got.items()}
    hits = sum(len(found[q] & {i for i, _ in own[0]}) for q, own in true.items())
    assert set(found) == set(true) and hits >= 0.9 * sum(len(own[0]) for own in true.values())


def test_alignment_bounds_its_batches(spark):
    """A task turns 4 MB of texts into Python strings at once, not Spark's default of 10,000 rows or 64 MB."""
    import public_tokenizers

    from platter.llm import alignment

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    files = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    alignment.link_rows(docs, *files, public_tokenizers.PATTERN, "doc_id", "text")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20


def test_chunks_are_told_once_and_words_go_to_the_libraries_together(monkeypatch):
    """Alike chunks of texts cost no second call, many words share one, and odd texts come out as in the plain version."""
    rng = random.Random(3)
    odd = [" ", "  ", "\t", "\n", "\u2581", "\x1c", "\x85", "\xa0", "\u3000", "a", "don't", "1234", "\u65e5\u672c", "\xe9", "e\u0301", "<s>", "<0x41>", "<|endoftext|>", "\x00", "the", ",", "x\n  y"]
    rows = [(n, rng.choice(["", " "]).join(rng.choices(odd, k=rng.choice([1, 2, 4, 12])))) for n in range(300)]
    plain = [(300 + n, " ".join(f"w{k % 700}," for k in range(n, n + 900))) for n in range(20)]
    expected = {r[0]: r for r in aligned(rows + plain)}
    for most in (10, 1_000_000):  # forgetting changes nothing
        own, calls = alignment.Aligner(A_FILE, B_FILE, P.PATTERN, most), []
        inner = own.b.model.encode

        class Counted:
            def encode(self, given, **more):
                calls.append(given)
                return inner(given, **more)

        monkeypatch.setattr(own.b, "model", Counted())
        for part in (rows[:150], rows[150:], plain):
            calls.clear()
            for (key, _), (told, line, pairs, links) in zip(part, own.rows([t for _, t in part]), strict=True):
                want = expected[key]
                assert told == want[1:5] and len(set(pairs.tolist())) == len(pairs) and links.sum() == told[3]
                assert ("" if line is None else hashlib.sha256(line).hexdigest()) == want[-1]
        assert len(calls) <= 4  # 18,000 words in the last texts, 700 of them different
