"""The training-data operators against brute-force versions, and their edge cases."""

import base64
import hashlib
import itertools
import math
import os
import random
import re
import struct
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from platter.llm import bpe, chat, components, langid, nearcopies, packing, pii, quality, queries, secrets, simhash, toxicity, vectors
from platter.llm.common import complete_groups

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, "en", "s", 0), (2, "", "en", None, 0), (3, "  \n\t", None, "s", 4), (4, "two words", "en", "s", 9), (4, "two words", "en", "s", 9),
    (None, "a b c d e f", "en", "s", 11), (5, "x y z " * 3000, "en", "s", 18000), (6, "\u00e9\u0301 🙂 \x1c 中文 ſ <|endoftext|> it's", "en", "s", 20),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def closure(ids, linked):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_components_equal_brute_force(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100, k) for k in range(101, 140)] + [(k, k + 1) for k in range(200, 230)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = closure({x for e in edges for x in e}, edges)
    assert got == {k: v for k, v in want.items() if k != v}


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 16))
    x = np.concatenate([base, base[:20] + 0.08 * rng.standard_normal((20, 16)), base[:3], 2 * base[3:5]])
    rows = [(k, v.tolist(), "x") for k, v in enumerate(x)] + [(900, None, "x"), (901, [0.0] * 16, "x"), (902, [float("nan")] * 16, "x"), (903, [], "x"), (904, [1.0, 2.0], "x"), (905, [1.0, None], "x")]
    got = vectors.vector_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept string"), miss=1e-6, block=4)
    got = {r["vec_id"]: r for r in got.collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T) >= 0.9
    label = closure(range(len(x)), np.argwhere(near).tolist())
    for k in range(len(x)):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (near[k].sum() - 1, label[k], label[k] == k)
    assert all(got[k]["component_id"] == k and got[k]["n_links"] == 0 for k in range(900, 906)) and len(got) == len(rows)


def test_vector_recall(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((1500, 64))
    x = np.concatenate([base, base[:500] + 0.42 * rng.standard_normal((500, 64))])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    exact = int(((u @ u.T) >= 0.9).sum()) - len(x)
    found = vectors.vector_components(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>"))
    assert 0.99 * exact <= found.agg(F.sum("n_links")).first()[0] <= exact


@pytest.mark.parametrize("dim", [1, 5, 64, 100])
def test_sketch_estimates(dim):
    """Sketches survive packing, their estimates have no bias, and the bounds hold for nearly all pairs."""
    rng = np.random.default_rng(dim)
    base = vectors.normalised(rng.standard_normal((400, dim)))
    unit = np.concatenate([base, vectors.normalised(base + 0.45 / np.sqrt(dim) * rng.standard_normal((400, dim)))])
    signs = vectors.sign_bits(unit, vectors.CODES * dim)
    code, query, numbers = vectors.unpacked(vectors.sketches(unit, signs), dim)
    assert (code == signs).all()
    true = unit @ unit.T
    turned = unit @ vectors.rotation(dim, 0)
    assert np.allclose(np.linalg.norm(turned - query, axis=1), numbers[:, 2], atol=1e-6)
    near, estimate = true >= 0.9, vectors.mean_codes(code, dim) @ query.T / numbers[:, :1]
    maybe = vectors.undecided(code, query, numbers, 0.9, 4.0)
    assert (maybe == maybe.T).all() and (maybe & near).sum() >= 0.999 * near.sum()
    assert abs((estimate - true)[: 400, 400:].mean()) < 0.01
    if dim >= 64:  # far pairs are turned away
        assert maybe[true < 0.5].mean() < 0.002


def brute_print(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    grams = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, docs, odd):
    both = docs.unionByName(odd)
    rows = both.select("doc_id", "text").collect()
    prints = {}
    for r in rows:
        prints.setdefault(brute_print(r["text"]), []).append(r["doc_id"])
    keys = list(prints)
    links = [(a, b) for n, a in enumerate(keys) for b in keys[:n] if (a ^ b).bit_count() <= 2]
    label = closure(keys, links)
    least = {}
    for k in keys:
        least[label[k]] = min([least.get(label[k], 1 << 60), *(i for i in prints[k] if i is not None)])
    least = {k: None if v == 1 << 60 else v for k, v in least.items()}
    want = sorted((str(i), f"{k:016x}", least[label[k]]) for k in keys for i in prints[k])
    got = simhash.simhash_components(both, block=8).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got) == want


def test_covering_masks_cover_every_pair_of_bits():
    masks = simhash.covering_masks(2)
    assert all(any(not m >> i & 1 and not m >> j & 1 for m in masks) for i in range(64) for j in range(i + 1))


def test_keep_one_of_each(odd):
    kept = simhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "5", "6", "None"]


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    """A copy of document 1 under id 2 goes, the other text under id 2 stays; equal rows of one id leave one."""
    words = lambda a: " ".join(f"{a}{k}" for k in range(80))
    rows = [(1, words("x"), "en", "s", 1), (2, words("x"), "en", "s", 2), (2, words("y"), "en", "s", 3), (3, words("z"), "en", "s", 4), (3, words("z"), "en", "s", 5), (4, words("y"), "en", "s", 6)]
    given = spark.createDataFrame(rows, "doc_id long, text string, component_id string, __rows string, c0 int")
    for module in (simhash, nearcopies):
        kept = module.keep_one_of_each(given)
        assert kept.columns == given.columns
        assert sorted((r["doc_id"], r["text"][0]) for r in kept.collect()) == [(1, "x"), (2, "y"), (3, "z")]


def test_quality_edges(odd):
    got = {r["doc_id"]: r for r in quality.judge(odd).collect()}
    assert got[1]["n_words"] == got[2]["n_words"] == got[3]["n_words"] == 0 and got[1]["base_failed"]
    assert got[5]["n_words"] == got[5]["n_repeat_words"] == 9000 and not got[5]["kept"]
    assert quality.keep_good(odd).count() == 0
    assert quality.judge(odd.limit(0)).count() == 0


def test_suspect_host_loses_its_soft_failures_only(spark):
    fine, symbols = " ".join(f"word{k}" for k in range(60)), " ".join(f"#w{k}*" for k in range(60))
    rows = [(k, symbols if k < 80 else fine, "en", "bad", 1) for k in range(100)] + [(k, symbols if k == 300 else fine, "en", "good", 1) for k in range(300, 400)]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, DOCS)).collect()}
    assert not any(got[k] for k in range(80)) and all(got[k] for k in range(80, 100)) and all(got[k] for k in range(300, 400))


def test_host_is_judged_against_the_corpus(spark):
    """Forty failures in a hundred are many where the corpus has ten, and few where it has sixty; one in two proves nothing."""
    fine, symbols = " ".join(f"word{k}" for k in range(60)), " ".join(f"#w{k}*" for k in range(60))
    host = lambda name, first, bad, n: [(first + k, symbols if k < bad else fine, "en", name, 1) for k in range(n)]
    low = [r for k in range(8) for r in host(f"h{k}", 1000 * k, 5 + k, 100)]
    high = [r for k in range(8) for r in host(f"h{k}", 1000 * k, 55 + k, 100)]
    suspects = lambda rows: {r["doc_id"] // 1000 for r in quality.judge(spark.createDataFrame(rows, DOCS)).filter("host_suspect").collect()}
    assert suspects(low + host("x", 90_000, 40, 100) + host("y", 95_000, 1, 2)) == {90}
    assert 90 not in suspects(high + host("x", 90_000, 40, 100))


def test_quality_keeps_columns_of_any_name(spark):
    """Extra columns may bear the names that the operator uses itself, or names that differ in case only."""
    text = " ".join(f"word{k}" for k in range(60))
    given = spark.createDataFrame([(1, text, "s", 1, 2, 3, 4)], "doc_id long, text string, source string, __t int, __w int, __q_base int, c0 int")
    assert quality.keep_good(given).collect() == given.collect() and quality.judge(given).count() == 1


def test_repeated_windows_equal_brute_force(spark):
    rng = random.Random(15)
    rows = [(k, " ".join(rng.choices("abc", k=rng.randint(0, 40)) + [f"u{n}" for n in range(rng.randint(0, 30))]), "en", "s", 1) for k in range(200)]
    for r in quality.judge(spark.createDataFrame(rows, DOCS)).collect():
        words = rows[r["doc_id"]][1].split()
        grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        inside = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        assert r["n_repeat_words"] == len(inside)


def test_quality_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{DATA}/documents.parquet')")
    theirs = con.sql(queries.oracle_sql()["op2_quality_rules"])
    ours = queries.queries()["op2_quality_rules"](spark, DATA).select(theirs.columns)
    assert sorted(map(tuple, ours.collect())) == sorted(theirs.fetchall())


def test_packing(spark, docs, odd):
    path = public_tokenizers.path("byte_bpe_50k.json")
    both = docs.unionByName(odd.filter("doc_id IS NOT NULL").withColumn("doc_id", F.col("doc_id") + 1_000_000).dropDuplicates(["doc_id"]))
    got = packing.pack(both, path, public_tokenizers.PATTERN).collect()
    tokenizer = Tokenizer.from_file(path)
    want = {r["doc_id"]: tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in both.collect()}
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(want)
    for k, own in by_doc.items():
        own.sort(key=lambda r: r["piece"])
        at = 0
        for n, r in enumerate(own):
            part = want[k][at : at + r["length"]]
            assert (r["piece"], r["start"]) == (n, at) and r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            assert len(own) == 1 or n == 0 or r["length"] == 2048
            at += r["length"]
        assert at == len(want[k])
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(by_sequence) <= 1.02 * sum(map(len, want.values())) / 2048 + 1
    assert packing.pack(docs.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_plan_places_every_piece_once():
    rng = random.Random(4)
    histogram = {rng.randint(1, 64): rng.randint(1, 50) for _ in range(40)} | {64: 7}
    runs, sequences, figures = packing.plan(histogram, 64)
    assert figures["rest"] <= 0.1 * sum(histogram.values())
    load, count = {}, {}
    for size, first, end, start, copies, offset in runs.tolist():
        count[size] = count.get(size, 0) + end - first
        for k in range(end - first):
            load.setdefault(start + k // copies, set()).update(range(offset + k % copies * size, offset + (k % copies + 1) * size))
    assert count == histogram and len(load) == sequences
    assert sum(map(len, load.values())) == sum(s * n for s, n in histogram.items())
    assert all(v == set(range(len(v))) and len(v) <= 64 for v in load.values())


def test_knapsack_equals_brute_force():
    rng = random.Random(5)
    for _ in range(30):
        lengths = np.array(sorted(rng.sample(range(1, 15), 4)))
        price, limit = np.array([rng.uniform(0.5, 2) * s for s in lengths]), np.array([rng.randint(1, 3) for _ in lengths])
        table, best = packing.Knapsack(price, lengths, limit, 20), {}
        for copies in itertools.product(*(range(n + 1) for n in limit)):
            total = int(lengths @ copies)
            if total <= 20:
                best[total] = max(best.get(total, 0.0), float(price @ copies))
        reachable = np.array(sorted(best))
        assert np.array_equal(np.flatnonzero(np.isfinite(table.best)), reachable)
        found = table.fillings(reachable)
        assert np.array_equal(found @ lengths, reachable) and (found <= limit).all()
        assert np.allclose(found @ price, [best[int(t)] for t in reachable]) and np.allclose(table.best[reachable], found @ price)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_the_program_places_nearly_all_pieces(sf):
    """On the given tables at most a tenth of the shorter pieces is left to best fit, and sequences stay near the bound."""
    texts = duckdb.sql(f"SELECT coalesce(text, '') FROM read_parquet('/root/testdata/{sf}/documents.parquet')").fetchall()
    tokenizer, histogram = packing.TextTokenizer(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN), {}
    for start in range(0, len(texts), 500):
        for ids in tokenizer.ids([t for (t,) in texts[start : start + 500]]):
            for _, size in packing.cut(np.append(ids, 0), 2048):
                histogram[size] = histogram.get(size, 0) + 1
    _, sequences, figures = packing.plan(histogram, 2048)
    assert figures["bound"] <= figures["value"] <= 1.02 * figures["bound"]
    assert figures["rest"] <= 0.5 * sum(n for size, n in histogram.items() if size < 2048)
    plain = sum(times for _, times in packing.best_fit(histogram, 2048))
    assert sequences <= plain and sequences <= {"sf0.001": 96, "sf0.01": 481, "sf0.1": 4936}[sf]


def test_program_covers_and_is_bounded():
    """Every solution covers all demand, its configurations fit, and the bound holds for the best integer packing found."""
    rng = np.random.default_rng(6)
    for trial in range(20):
        lengths = np.sort(rng.choice(np.arange(1, 41), size=int(rng.integers(1, 12)), replace=False))
        demand = rng.integers(1, [3, 50, 10**9][trial % 3], size=len(lengths)).astype(float)
        found, bound = packing.fractional(lengths, demand, 40)
        covered = dict.fromkeys(lengths.tolist(), 0.0)
        for key, amount in found:
            assert sum(size * n for size, n in key) <= 40 and amount > 0
            for size, n in key:
                covered[size] += n * amount
        assert all(covered[size] >= (1 - 2e-4) * d for size, d in zip(lengths.tolist(), demand))
        packed = packing.best_fit(dict(zip(lengths.tolist(), demand.astype(int).tolist())), 40)
        assert bound <= sum(times for _, times in packed) + 1e-6


def test_best_fit_on_counts_equals_pieces():
    """Groups of equal sequences give what placing piece by piece gives."""
    rng = np.random.default_rng(7)
    for _ in range(60):
        histogram = {int(s): int(rng.integers(1, 9)) for s in rng.choice(np.arange(1, 31), size=int(rng.integers(1, 9)), replace=False)}
        groups = packing.best_fit(histogram, 30)
        used = {}
        for config, times in groups:
            assert config and times > 0 and sum(s * n for s, n in config.items()) <= 30
            for s, n in config.items():
                used[s] = used.get(s, 0) + n * times
        room = []
        for size in sorted(histogram, reverse=True):
            for _ in range(histogram[size]):
                fits = [k for k, r in enumerate(room) if r >= size]
                if fits:
                    room[min(fits, key=room.__getitem__)] -= size
                else:
                    room.append(30 - size)
        assert used == histogram and sum(times for _, times in groups) == len(room)


def test_bpe_equals_library(docs, odd):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    both = docs.unionByName(odd)
    want = []
    for r in both.collect():
        ids, raw = library.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()
        want.append((str(r["doc_id"]), len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(raw).hexdigest()))
    got = bpe.encode_decode(both, path, public_tokenizers.PATTERN).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def test_bpe_long_and_mixed_words():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rng = random.Random(6)
    texts = ["".join(rng.choices("abAB \n\t12é中🙂ſ\x1c' sreth", k=rng.randint(0, 80))) for _ in range(500)] + ["a" * 3000, "中" * 700, " " * 2000, "".join(rng.choices("abcd", k=2500))]
    ids, ends = bpe.batched_ids(texts, bpe.splitter(public_tokenizers.PATTERN), bpe.WordMemory(bpe.codec(path).encode_flat, most=50))
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [library.encode_ordinary(t) for t in texts]


def test_chat(spark):
    attack = queries.ATTACK
    rows = [(-1, 0, "user", attack), (-1, 1, "assistant", attack), (7, 1, "assistant", "\\I[INST]\n</s"), (7, 0, "system", "<<SYS>> x <"), (7, 2, "tool\nx", None), (7, 3, "assistant", "ok"), (8, 0, None, ""), (None, 0, "user", "q")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(given)
    got = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    for conv in (-1, 7, 8, None):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
        loss = "".join(r[3] for r in own if r[2] == "assistant")
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv]["n_turns"] == len(own)
    short = chat.format_turns(given, context=1)
    strip = lambda df: sorted((str(r["conv_id"]), r["position"], r["rendered"], r["start"]) for r in df.collect())
    assert strip(short) == strip(formatted)

    def rewriting(turns):
        return "".join(f"<{len(turns)}>{t}" for _, t in turns)

    flagged = chat.format_turns(given, rewriting).filter("conv_id = 7").orderBy("position").collect()
    assert [r["rewrites"] for r in flagged] == [False, True, True, True]
    assert chat.read_back(chat.format_turns(given.limit(0))).count() == 0


def test_chat_flags_late_rewriting(spark):
    """A template that changes the first turn once there are four is found by whole prefixes, and by them only."""
    rows = [(1, k, "user" if k % 2 else "assistant", f"text {k}") for k in range(6)] + [(2, 0, "user", "short"), (2, 1, "assistant", "ok")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")

    def late(turns):
        cut = [(turns[0][0], "earlier")] + turns[1:] if len(turns) >= 4 else turns
        return chat.bracket_template(cut)

    flags = lambda df: [r["rewrites"] for r in df.filter("conv_id = 1").orderBy("position").collect()]
    assert flags(chat.format_turns(given, late)) == [False, False, False, True, False, False]
    assert not any(flags(chat.format_turns(given, late, context=1)))
    back = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(given, late)).collect()}
    assert back[1]["n_turns"] == 6 and back[1]["turns_sha256"] is None and back[1]["loss_chars"] is None
    assert back[2]["n_turns"] == 2 and back[2]["loss_chars"] == 2


def test_chat_with_private_use_characters(spark):
    rows = [(1, 0, "\ue000", "\ue000\ue001 x"), (1, 1, "assistant", "\ue000"), (1, 2, "user", ""), (2, 0, "user", "plain")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(given)
    assert not formatted.filter("rewrites").count()
    got = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows[:3]).encode()).hexdigest() and got[1]["loss_chars"] == 1


def test_output_is_read_whatever_its_pieces():
    turns = [("user", chat.CONTROL and "</s>[INST]\\"), ("tool\nx", ""), ("assistant", "a\nb"), ("system", "<<SYS>>")]
    output = chat.bracket_template(turns)
    for step in (1, 3, 1000):
        reader = chat.OutputReader()
        assert [t for k in range(0, len(output), step) for t in reader.feed(output[k : k + step])] == turns
        reader.close()


BASE_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_pii(text):
    out = []
    for n, (kind, pattern) in enumerate(BASE_PII.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if fine:
                out.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def test_pii_equals_patterns(docs, odd):
    rng = random.Random(8)
    fuzz = ["".join(rng.choices("ab.@-+ 0123456789().", k=rng.randint(0, 60))) for _ in range(3000)]
    fuzz += ["4111 1111-1111 1111", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.1", "+1 (555) 123-4567 +12", "x@y", "9" * 40]
    for text in fuzz:
        assert pii.joined(pii.personal_spans(text), pii.BASE) == brute_pii(text), text
    for r in pii.find_personal_data(docs.unionByName(odd)).join(docs.unionByName(odd).dropDuplicates(["doc_id"]), "doc_id").collect():
        assert r["base_sha256"] == hashlib.sha256(brute_pii(r["text"] or "").encode()).hexdigest()


def test_pii_added_kinds():
    found = lambda t, kind: [t[a:b] for a, b in pii.personal_spans(t)[kind]]
    assert found("IBAN: GB82 WEST 1234 5698 7654 32 ok", "account") == ["GB82 WEST 1234 5698 7654 32"]
    assert found("IBAN: GB83 WEST 1234 5698 7654 32 ok", "account") == []
    assert found("account no. 12345678, discount 99999999", "account") == ["12345678"]
    assert found("ftp://me:pw@host.example/x", "login") == ["me:pw"]
    assert found("write to jo.doe [at] mail [dot] org", "hidden_email") == ["jo.doe [at] mail [dot] org"]
    long = "n" * 700
    assert found(f"x {long} (at) mail (dot) org", "hidden_email") == [f"{long} (at) mail (dot) org"]


BASE_SECRETS = {"assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}


def brute_secrets(text):
    fine = {"assign": lambda m: len(m[2]) >= 12, "access": lambda m: len(m[0]) >= 18, "hex": lambda m: len(m[0]) >= 16}
    out = [(m.start(), n, f"{k}:{m.start()}:{m.end()}") for n, (k, p) in enumerate(BASE_SECRETS.items()) for m in re.finditer(p, text, re.A) if fine[k](m)]
    return ",".join(x[2] for x in sorted(out))


def test_secrets(docs, odd):
    rng = random.Random(9)
    fuzz = ["".join(rng.choices(["token", "Api_Key", "=", ": ", '"', "AKIA", "AB12CD34", "deadbeef", "x", " "], k=rng.randint(0, 14))) for _ in range(3000)]
    for text in fuzz:
        assert secrets.joined(secrets.base_spans(text), secrets.BASE) == brute_secrets(text), text
    both = docs.unionByName(odd)
    texts = {r["doc_id"]: r["text"] or "" for r in both.collect()}
    for r in secrets.find_secrets(both).collect():
        assert r["base_sha256"] == hashlib.sha256(brute_secrets(texts[r["doc_id"]]).encode()).hexdigest()
    assert secrets.redact_secrets(both).columns == both.columns and secrets.redact_secrets(both).count() == both.count()


def test_grammar_tells_credentials_from_words():
    rng = random.Random(10)
    key = lambda: "sk" + "".join(rng.choices("0123456789abcdefXYZ", k=24))
    word = lambda: "".join(rng.choice(["ing", "er", "the", "an", "or", "ti"]) for _ in range(7))
    grammar = secrets.Grammar([key() for _ in range(200)], [word() for _ in range(200)], [word() for _ in range(500)])
    assert sum(grammar.score(key()) > grammar.margin for _ in range(50)) >= 48
    assert not any(grammar.score(word()) > grammar.margin for _ in range(50))
    text = f"see {key()} now"
    assert secrets.redacted(text, grammar) == "see [SECRET] now"
    assert secrets.redacted("password=abcdefghijkl0 AKIA" + "A" * 16, None) == "password=[SECRET] [SECRET]"
    # Unlabelled secrets among the ordinary tokens don't hide their own kind.
    mixed = secrets.Grammar([key() for _ in range(50)], [word() for _ in range(150)] + [key() for _ in range(50)], [word() for _ in range(300)] + [key() for _ in range(30)])
    assert sum(mixed.score(key()) > mixed.margin for _ in range(50)) >= 48


@pytest.mark.parametrize("labelled", [3, 60])
def test_planted_secrets_are_found_in_a_table(spark, docs, labelled):
    """Tokens of a format that only labels show, without keyword, prefix or hex run: each is found, and nothing else."""
    rng = random.Random(12)
    key = lambda: "-".join("".join(rng.choices("0123456789ghjkmnpqrstvwxyzGHJKMNPQRSTVWXYZ", k=8)) for _ in range(4))
    rows = [(5_000 + k, f"set api_key = {key()} here") for k in range(labelled)] + [(6_000 + k, f"the value {key()} leaked") for k in range(40)]
    both = docs.unionByName(spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], DOCS))
    found = {r["doc_id"]: r for r in secrets.find_secrets(both).collect()}
    assert all(f"format:10:{10 + 35}" in found[6_000 + k]["spans"] for k in range(40))
    assert all(r["n_format"] == 0 for k, r in found.items() if k < 5_000)
    assert all(found[5_000 + k]["n_likely"] == 1 for k in range(labelled)) and sum(r["n_candidates"] for r in found.values()) > 500


def test_grammar_counts_every_document(spark):
    """No sample: each of 700 credentials counts, also where only frequent prefixes make states; the margin is the exact rank."""
    rng = random.Random(19)
    key = lambda: "".join(rng.choices("0123456789ghjkGHJK", k=rng.randint(14, 20)))
    keys = sorted({key() for _ in range(700)})
    docs = spark.createDataFrame([(k, f"password={v} plain{v[:3].lower()} word") for k, v in enumerate(keys)], "doc_id long, text string")
    for most in (secrets.MOST_PREFIXES, 50):
        grammar = secrets.infer_grammar(docs, most=most)
        assert sum(grammar.credential.count[0].values()) >= len(keys)
        steps = sum(n for counts in grammar.credential.count for n in counts.values())
        assert most > 50 or steps == sum(len(v) + 1 for v in keys)
        assert all(grammar.score(v) > grammar.margin for v in keys)
    scores = [rng.gauss(0, 2) for _ in range(500)]
    weighted = spark.createDataFrame([(s, 3) for s in scores], "score double, n long")
    got = secrets.weighted_quantile(weighted, 0.995)
    assert abs(got - sorted(scores * 3)[int(0.995 * 1499)]) < 1e-8 and secrets.weighted_quantile(weighted.limit(0), 0.5) is None


def plain_merging(words, bound):
    """Red-blue merging over nested dictionaries, written plainly: the language as a function of a word."""

    def node():
        return {"n": {}, "to": {}}

    def tree(into, word):
        for c in word:
            into["n"][c] = into["n"].get(c, 0) + 1
            into = into["to"].setdefault(c, node())
        into["n"]["$"] = into["n"].get("$", 0) + 1

    def close(x, y):
        n, m = sum(x["n"].values()), sum(y["n"].values())
        if n and m and any(abs(x["n"].get(c, 0) / n - y["n"].get(c, 0) / m) > bound * (n**-0.5 + m**-0.5) for c in {*x["n"], *y["n"]}):
            return False
        return all(close(x["to"][c], t) for c, t in y["to"].items() if c in x["to"]) if n and m else True

    def fold(x, y):
        for c, k in y["n"].items():
            x["n"][c] = x["n"].get(c, 0) + k
        for c, t in y["to"].items():
            if c in x["to"]:
                fold(x["to"][c], t)
            else:
                x["to"][c] = t

    root = node()
    for word in words:
        tree(root, word)
    red = [root]
    while True:
        blue = [(r, c) for r in red for c in sorted(r["to"]) if not any(r["to"][c] is x for x in red)]
        if not blue:
            break
        parent, c = blue[0]
        state = parent["to"][c]
        same = next((r for r in red if close(r, state)), None)
        if same is None:
            red.append(state)
        else:
            parent["to"][c] = same
            fold(same, state)

    def counts(word):
        at, out = root, []
        for c in word:
            out.append(at["n"])
            at = at["to"].get(c, root)
        return [*out, at["n"]]

    return counts


def test_merging_equals_a_plain_version():
    rng = random.Random(13)
    for alpha in (0.9, 0.3, 0.05):
        words = ["".join(rng.choices(["g", "G", "0", "+"], weights=[4, 2, 2, 1], k=rng.randint(1, 6))) for _ in range(60)] + ["g0" * k for k in range(1, 6)]
        made = secrets.Automaton(words, alpha)
        counts = plain_merging([w.translate(str.maketrans("gG0+", "luds")) for w in words], made.bound)
        for word in words + ["".join(rng.choices("gG0+", k=5)) for _ in range(40)]:
            symbols, state, path = word.translate(str.maketrans("gG0+", "luds")), 0, []
            for c in symbols:
                path.append(dict(made.count[state]))
                state = made.next[state].get(c, 0)
            assert [*path, dict(made.count[state])] == counts(symbols)


def test_language(spark):
    frames = queries.queries()["op9_language_id"](spark, DATA).collect()
    assert len(frames) == spark.read.parquet(f"{DATA}/pages.parquet").count()
    agree = np.mean([r["lang"] == r["declared"] for r in frames])
    assert agree > 0.9 and all(0 < r["posterior"] <= 1 for r in frames)
    model = langid.fit_trigrams(spark.read.parquet(f"{DATA}/documents.parquet"))
    pages = spark.createDataFrame([(1, None, None), (None, "x", ""), (2, "http://a.de/de/1", "<html lang=de><p>und der die</p>")], "page_id long, url string, html string")
    got = langid.identify(pages, model).collect()
    assert len(got) == 3 and langid.identify(pages.limit(0), model).count() == 0


def plain_posterior(pages, model, strength=10.0):
    """The fusion of the evidence, page by page in plain Python."""
    size, codes = len(model.languages), "|".join(x.lower() for x in model.languages)
    rows = []
    for _, url, html in pages:
        url, html = (url or "").lower(), html or ""
        host = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", url)
        host = host[1] if host else ""
        code = re.match(rf"[^:]*://[^/]*/({codes})(?:[/?#]|$)", url)
        told = re.search(r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]+)", html)
        loglik = model.text(langid._HIDDEN.sub(" ", html), {})
        keys = {"host": host, "site": ".".join(host.split(".")[-2:]), "suffix": host.split(".")[-1], "path_code": code[1] if code else "", "declared": told[1].lower() if told else ""}
        votes = (loglik == loglik.max()) * float(loglik.max() < 0)  # none without words; ties share one
        rows.append((loglik, votes / max(votes.sum(), 1), keys))
    counts = {}
    for _, votes, keys in rows:
        for key, value in keys.items():
            counts[key, value] = counts.get((key, value), np.zeros(size)) + votes
    smooth = lambda n, p: (n + strength * p) / (n.sum() + strength)
    corpus, out = smooth(sum(votes for _, votes, _ in rows), np.full(size, 1 / size)), []
    for loglik, votes, keys in rows:
        less = lambda key: np.maximum(counts[key, keys[key]] - votes, 0)  # noqa: B023, E731
        terms = loglik + np.log(smooth(less("host"), smooth(less("site"), corpus)))
        for key in ("declared", "suffix", "path_code"):
            terms = terms + np.log(smooth(less(key), corpus) / corpus)
        p = np.exp(terms - terms.max())
        out.append((model.languages[int(np.argmax(terms))], 1 / p.sum()))
    return out


def rendered_pages(docs, rng, chars):
    """Documents as pages of their language's hosts: some undeclared, some short, some that declare a wrong language."""
    rows = []
    for k, (text, lang) in enumerate(docs):
        declared = {0: "", 1: lang, 2: lang, 3: rng.choice(["en", "de", "fr", "es"])}[k % 4]
        host = rng.choice([f"{lang}.big.example", f"www.own{k % 5}.{lang}", "mixed.example"])
        path = f"/{lang}/" if k % 3 == 0 else "/"
        rows.append((k, f"http://{host}{path}p{k}", f"<html{f' lang={declared}' if declared else ''}><p>{text[:chars]}</p></html>"))
    return rows


@pytest.mark.parametrize("most", [langid.BROADCAST_KEYS, 8])
def test_fusion_equals_plain_version(spark, docs, most):
    rng = random.Random(16)
    given = [(r["text"], r["lang"]) for r in docs.filter("length(text) > 200").orderBy("doc_id").collect()]
    pages = rendered_pages(given, rng, 12) + [(9_000 + k, *rest) for k, rest in enumerate([(None, None), ("", "<html lang=de>"), ("http://a.fr/es", "")])]
    model = langid.fit_trigrams(docs)
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in langid.identify(table, model, broadcast_keys=most).collect()}
    assert len(got) == len(pages)
    for (key, _, _), (lang, posterior) in zip(pages, plain_posterior(pages, model)):
        assert got[key]["posterior"] == pytest.approx(posterior, rel=1e-6)
        assert got[key]["lang"] == lang or posterior < 0.51


def test_blank_pages_have_no_vote(spark, docs):
    """A host full of blank pages says nothing; pages of a French host without words are French."""
    model = langid.fit_trigrams(docs)
    french = [r["text"] for r in docs.filter("lang = 'fr' AND length(text) > 200").collect()]
    pages = [(k, "http://one.example/a", f"<p>{french[k % len(french)]}</p>") for k in range(60)]
    pages += [(100 + k, "http://two.example/b", "<p> 12 </p>") for k in range(60)] + [(200, "http://one.example/c", None)]
    got = {r["page_id"]: r for r in langid.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), model).collect()}
    assert {got[k]["lang"] for k in [*range(60), *range(100, 160), 200]} == {"fr"}
    assert {got[k]["text_lang"] for k in range(100, 160)} == {None} and got[200]["posterior"] > 0.9


def test_language_of_rendered_documents(spark, docs):
    """Labelled documents as pages: the whole text decides; on two letters the other evidence mends what the text gets wrong."""
    rng = random.Random(17)
    given = [(r["text"], r["lang"]) for r in docs.filter("length(text) > 200").orderBy("doc_id").collect()]
    model = langid.fit_trigrams(docs)
    right = {}
    for chars in (2, 10_000):
        table = spark.createDataFrame(rendered_pages(given, rng, chars), "page_id long, url string, html string")
        rows = langid.identify(table, model).collect()
        right[chars] = [np.mean([r[c] == given[r["page_id"]][1] for r in rows]) for c in ("lang", "text_lang")]
    assert right[10_000][0] >= 0.99 and right[2][0] > right[2][1] + 0.05, right


def test_conflicting_evidence(spark, docs):
    """A long text outweighs a wrong declaration; a page without words follows its host, and what it declares."""
    model = langid.fit_trigrams(docs)
    texts = {x: next(r["text"] for r in docs.filter(f"lang = '{x}' AND length(text) > 2000").collect()) for x in ("de", "fr")}
    pages = [(k, f"http://a.de/{k}", f"<html lang=de><p>{texts['de']}</p>") for k in range(30)]
    pages += [(100 + k, f"http://b.fr/{k}", f"<html lang=fr><p>{texts['fr']}</p>") for k in range(30)]
    pages += [(200, "http://b.fr/x", f"<html lang=fr><p>{texts['de']}</p>"), (201, "http://a.de/x", "<html><p></p>"), (202, "http://c.net/x", "<html lang=fr><p></p>")]
    got = {r["page_id"]: r["lang"] for r in langid.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), model).collect()}
    assert (got[200], got[201], got[202]) == ("de", "de", "fr")


def test_language_of_equal_pages(spark, docs):
    """All ties: equal pages get equal answers."""
    model = langid.fit_trigrams(docs)
    pages = spark.createDataFrame([(k, "http://x.com/", "<html><p>la</p>") for k in range(40)], "page_id long, url string, html string")
    assert len({(r["lang"], r["posterior"]) for r in langid.identify(pages, model).collect()}) == 1


def brute_segments(hits, n, drift):
    """Maximal segments by their recursive definition: the best one, then left and right of it."""
    values = [-drift] * n
    for place, score in hits:
        values[place] = score

    def search(a, b):
        best = max(((sum(values[i:j]), -(j - i), -i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if best is None or best[0] <= 1e-12:
            return []
        i, j = -best[2], best[3]
        return [*search(a, i), (round(best[0], 6), i, j - 1), *search(j, b)]

    return search(0, n)


def test_segments_equal_definition():
    rng = random.Random(11)
    for _ in range(150):
        n = rng.randint(1, 18)
        hits = [(k, rng.choice([1.0, 2.0, 3.0]) + rng.random() / 100) for k in range(n) if rng.random() < 0.4]
        got = [(round(s, 6), a, b) for s, a, b in toxicity.maximal_segments(hits, 0.7)]
        assert got == brute_segments(hits, n, 0.7)


def test_segment_scan_is_linear():
    """Isolated hits: four times as many take about four times as long, not sixteen times."""
    took = []
    for n in (20_000, 80_000):
        hits = [(5 * k, 1.0) for k in range(n)]
        start = time.perf_counter()
        assert len(toxicity.maximal_segments(hits, 0.5)) == n
        took.append(time.perf_counter() - start)
    assert took[1] < 10 * took[0]


def test_toxic_odds_law_and_score_equal_plain_formulas(spark):
    """A table with one toxic word; the lexicon, the extreme-value law and every score are computed again, plainly."""
    rng, words = random.Random(14), [f"{a}{b}" for a in "bcdfghklm" for b in ("ana", "eno", "iru", "oli")]
    rows = []
    for k in range(600):
        text = [rng.choice(words) for _ in range(rng.randint(20, 60))]
        if k % 3 == 0:
            for at in range(rng.randrange(9), len(text), 9):
                text[at] = "zonkish"
        rows.append((k, " ".join(text), int("zonkish" in text)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(table, table.select("doc_id", "toxic"), drifts=(0.05,), least_z=(3.0,))
    fold = lambda k: zlib.crc32(str(k).encode()) % 5
    forms = lambda w: [w] + [w[:k] + "-" for k in range(4, 8) if k < len(w)]
    seen, counts = set(), {}
    for k, text, y in rows:
        if fold(k) in (1, 2, 3) and text not in seen:
            seen.add(text)
            for w in set(text.split()):
                for f in forms(w):
                    counts.setdefault(f, [0, 0])[1 - y] += 1
    counts = {f: c for f, c in counts.items() if sum(c) >= 3}
    one, two = (sum(c[n] for c in counts.values()) for n in (0, 1))
    scores = {}
    for f, (a, b) in counts.items():
        if a * two <= b * one:
            continue
        p, q = a + 0.05 * (a + b), b + 0.05 * (a + b)
        delta = math.log(p / (one + 0.05 * (one + two) - p)) - math.log(q / (two + 0.05 * (one + two) - q))
        spread = math.sqrt(1 / p + 1 / q)
        if delta / spread >= 3 and delta - 1.96 * spread > 0:
            scores[f] = delta - 1.96 * spread
    assert "zonkish" in scores and model.scores == pytest.approx(scores)

    def best(text):
        values = [max([scores.get(f, 0.0) for f in forms(w)]) or -0.05 for w in text.split()]
        return max([sum(values[i:j]) for i in range(len(values)) for j in range(i + 1, len(values) + 1)] + [0.0])

    held = [(y, best(t), len(t.split())) for k, t, y in rows if fold(k) == 4]
    clean = [(b, n) for y, b, n in held if not y]
    mean = sum(b for b, _ in clean) / len(clean)
    rate = math.pi / (math.sqrt(6) * max(math.sqrt(sum((b - mean) ** 2 for b, _ in clean) / len(clean)), 0.25))
    log_k = sum(rate * b - math.log(n) for b, n in clean) / len(clean) - 0.5772156649
    assert (model.rate, model.log_k) == pytest.approx((rate, log_k))
    for r in toxicity.score_toxicity(table, model).collect():
        text = rows[r["doc_id"]][1]
        x = rate * best(text) - math.log(len(text.split())) - log_k
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, model.slope * x + model.intercept)))))
        assert r["held_out"] == (fold(r["doc_id"]) == 0) and r["predicted"] == int(r["score"] >= 0.5)
    found = toxicity.toxic_passages(table, model).collect()
    assert found and all("zonkish" in rows[r["doc_id"]][1][r["start"] : r["end"]] and r["e_value"] < 0.01 for r in found)


def test_toxicity_of_equal_texts(spark):
    """All ties: a table of one text gets one score, whatever its labels."""
    table = spark.createDataFrame([(k, "same words here", k % 2) for k in range(60)], "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(table, table.select("doc_id", "toxic"))
    assert len({r["score"] for r in toxicity.score_toxicity(table, model).collect()}) == 1


def test_toxicity_on_held_out_rows(spark):
    big = "/root/testdata/sf0.1" if os.path.isdir("/root/testdata/sf0.1") else "/root/testdata/sf0.01"
    scored = queries.queries()["op10_toxicity"](spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").filter("held_out")
    rows = scored.select("score", "predicted", "toxic").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert np.mean(toxic) > 0.92 and np.mean(clean) < 0.005


def test_toxicity_edges(spark, odd):
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(odd, labels)
    assert {r["score"] for r in toxicity.score_toxicity(odd, model).collect()} == {0.0}
    assert toxicity.drop_toxic(odd, model).count() == odd.count()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, kept, DATA)
        assert kept.columns == docs.columns
    packed = corpus_pipeline.run(spark, DATA)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in kept.select("doc_id").collect()}


#: Extra columns with the names that operators use for their own, and whole rows twice.
CLASH = ["fp", "node", "keys", "spans", "score", "kept", "predicted", "part", "__text", "__print", "h"]


@pytest.fixture(scope="module")
def huge(spark):
    """Texts of one to three million characters: one word, many words, one line again and again, secrets and mails."""
    rng = random.Random(18)
    texts = ["x" * 1_000_000, " ".join(f"word{rng.randrange(50_000)}" for _ in range(200_000)), "the same line of some words here\n" * 40_000,
             "token = 0123456789abcdef0123 me@host.example 1.2.3.4 " * 20_000, "short", "short", None]
    rows = [(k, t, "en", "s", len(t or ""), *([k] * len(CLASH))) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS + "".join(f", `{c}` int" for c in CLASH)).repartition(3)


def test_huge_texts_and_clashing_names(spark, huge):
    labels = spark.createDataFrame([(k, k % 2) for k in range(7)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(huge, labels)
    whole = huge.count()
    judged = {r["doc_id"]: r for r in quality.judge(huge).collect()}
    assert len(judged) == whole and judged[1]["n_words"] == 200_000 and judged[2]["n_dup_lines"] == 39_999 and judged[2]["base_failed"]
    found = {r["doc_id"]: r for r in pii.find_personal_data(huge).collect()}
    assert (found[3]["n_email"], found[3]["n_ip"], found[0]["n_email"]) == (20_000, 20_000, 0)
    found = {r["doc_id"]: r for r in secrets.find_secrets(huge).collect()}
    assert found[3]["n_assign"] == found[3]["n_hex"] == 20_000 and found[0]["n_hex"] == 0
    prints = {r["doc_id"]: r for r in simhash.simhash_components(huge).collect()}
    assert len(prints) == whole and prints[5]["component_id"] == 4
    assert toxicity.score_toxicity(huge, model).count() == whole
    encoded = {r["doc_id"]: r for r in bpe.encode_decode(huge, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).collect()}
    assert encoded[0]["decoded_sha256"] == hashlib.sha256(b"x" * 1_000_000).hexdigest()
    packed = packing.pack(huge, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    assert packed.select("doc_id").distinct().count() == whole
    for kept in (toxicity.drop_toxic(huge, model), secrets.redact_secrets(huge), quality.keep_good(huge), simhash.keep_one_of_each(huge), nearcopies.keep_one_of_each(huge)):
        assert kept.columns == huge.columns and kept.count() <= whole
    assert sorted(r["doc_id"] for r in nearcopies.keep_one_of_each(huge).collect()) == [0, 1, 2, 3, 4, 6]


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_pipeline_on_odd_and_empty_tables(spark, odd, tmp_path, rows):
    text = " ".join(f"word{k}" for k in range(80))
    good = spark.createDataFrame([(50, text, "en", "s", 1), (50, text, "en", "s", 1), (51, text + " more", "en", None, 1), (None, text, None, "s", None)], DOCS)
    given = odd.unionByName(good).withColumn("__t", F.lit(1)).withColumn("component_id", F.lit("x"))
    given = given.limit(0) if rows == "none" else given
    given.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(50, 0), (1, None), (None, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), None
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
    want = [] if rows == "none" else ["50", "None"]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want
    assert sorted({str(r["doc_id"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}) == want


def shingle_set(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", words) if w]
    return {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def near_texts():
    """Texts of 60 to 200 words with copies in which up to a tenth of the words differ, one apart or as a block."""
    rng, vocabulary, out = random.Random(8), [f"w{k}" for k in range(500)], []
    for _ in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(60, 200))]
        out.append(" ".join(words))
        for _ in range(4):
            copy, at = list(words), rng.randrange(50)
            for k in range(rng.randint(1, 8)):
                copy[at + k if rng.random() < 0.7 else rng.randrange(len(copy))] = "X"
            out.append(" ".join(copy))
    return out


def test_near_copies_equal_brute_force(spark, docs, odd):
    texts = spark.createDataFrame([(10_000 + k, t, "en", "s", len(t)) for k, t in enumerate(near_texts())], DOCS)
    both = docs.unionByName(odd.filter("doc_id IS NOT NULL").withColumn("doc_id", F.col("doc_id") - 100)).unionByName(texts)
    rows = [(r["doc_id"], shingle_set(r["text"])) for r in both.select("doc_id", "text").collect()]
    links = [(a, b) for n, (a, x) in enumerate(rows) for b, y in rows[:n] if 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and jaccard(x, y) >= 0.8]
    label = closure([a for a, _ in rows], links)
    got = nearcopies.similar_components(both, block=4).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == sorted((a, label[a]) for a, _ in rows)
    assert len({(r["component_id"], r["node"]) for r in got}) == len({(r["node"]) for r in got})
    assert len({a for a, b in label.items() if a >= 10_000 and a != b}) > 60


def test_pipeline_drops_edited_copies(spark):
    """No pair of the stage's output has five-word Jaccard 0.8 or more; two bits of a fingerprint leave most of them."""
    texts = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(near_texts())], DOCS)
    kept = corpus_pipeline.near_dedup(spark, texts, DATA)
    sets = [shingle_set(r["text"]) for r in kept.collect()]
    assert kept.columns == texts.columns and not [1 for n, a in enumerate(sets) for b in sets[:n] if jaccard(a, b) >= 0.8]


def test_near_copies_of_odd_rows(odd):
    assert sorted(str(r["doc_id"]) for r in nearcopies.keep_one_of_each(odd).collect()) == ["1", "4", "5", "6", "None"]


def test_long_near_copies_are_cut_by_size(spark, monkeypatch):
    """Sub-blocks hold few long texts, and no link between them is lost."""
    monkeypatch.setattr(nearcopies, "PLAIN", 16)
    base = [f"w{k}" for k in range(300)]
    texts = [(k, " ".join(base[: 7 * k] + [f"other{k}"] + base[7 * k + 1 :])) for k in range(40)] + [(90, "short text"), (91, "short text")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    sized = nearcopies.prints_of(df).filter("size > 100").select("node", "size", F.lit(1).alias("b"))
    items = components.work_items(sized, ["b"], "node", 64, F.greatest(F.lit(1.0), F.col("size") / F.lit(16)))
    rows = items.groupBy("left_block", "right_block").count().collect()
    assert len({r["left_block"] for r in rows}) == 12 and max(r["count"] for r in rows) < 25  # 40 texts of 18.5 rows each, 64 a block
    found = {r["doc_id"]: r["component_id"] for r in nearcopies.similar_components(df, block=64).collect()}
    assert found == {k: 0 for k in range(40)} | {90: 90, 91: 90}


def test_tables_end_by_bytes():
    batches = [pa.RecordBatch.from_arrays([pa.array([k // 3]), pa.array(["x" * 1000])], ["k", "t"]) for k in range(30)]
    cut = list(complete_groups(iter(batches), ["k"], rows=10_000, nbytes=5_000))
    assert len(cut) > 4 and max(t.num_rows for t in cut) <= 6
    assert [v for t in cut for v in t.column("k").to_pylist()] == [k // 3 for k in range(30)]
    assert all(set(a.column("k").to_pylist()).isdisjoint(b.column("k").to_pylist()) for a, b in zip(cut, cut[1:]))


def test_near_dedup_links_by_fingerprints_too(spark):
    """Texts that SimHash links and the shingles' Jaccard doesn't are one in the pipeline's stage; links of both kinds chain."""
    words = [f"w{k}" for k in range(60)]
    looped = words * 30
    # A long text and one with each shingle less often repeated: equal fingerprints need not have Jaccard 0.8.
    base = " ".join(looped)
    far = next(
        other for seed in range(500)
        if (other := " ".join(looped + [f"x{seed}_{k}" for k in range(30)])) and (simhash.fingerprint_of(base) ^ simhash.fingerprint_of(other)).bit_count() <= 2
    )
    a, b = nearcopies.shingles_of(base), nearcopies.shingles_of(far)
    assert len(np.intersect1d(a, b)) / len(np.union1d(a, b)) < 0.8
    near = far + " once more"
    rows = [(1, base), (2, far), (3, near), (4, "something else " * 9), (5, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    import corpus_pipeline

    assert sorted(r["doc_id"] for r in nearcopies.keep_one_of_each(docs).collect()) == [1, 2, 4, 5]
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 4, 5]
