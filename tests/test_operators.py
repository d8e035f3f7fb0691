"""Golden cases and properties of the library's operators."""

import gzip
import html
import json
import random
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from platter.functions import genres, text
from platter.operators import candidates, captures, extract, match, reviews, select, stats
from platter.operators.select import Selection
from platter.plans import queries, views
from platter.sources import readers, sinks


def column(spark, value, make):
    return spark.createDataFrame([(value,)], "v string").select(make("v").alias("x")).first()["x"]


@pytest.mark.parametrize("make, value, expected", [
    (text.clean_text, "A &amp;amp; B ​", "A & B"),
    (text.clean_text, None, ""),
    (text.loose_key, "The Mollusk", "mollusk"),
    (text.album_key_part, "Sigur Rós", "sigurros"),
    (text.album_key_part, "The Album (Deluxe Edition)", "thealbum"),
    (text.album_key_part, "日本", ""),
    (text.strict_key, "The Beatles", "beatles"),
    (text.strict_key, "St. Vincent", "streetvincent"),
    (text.title_tokens, "Rival Dealer EP", ["rival", "dealer"]),
    (text.title_tokens, "Superfuzz Bigmuff Deluxe Edition", ["superfuzz", "bigmuff"]),
    (text.title_tokens, "Album 25th Anniversary Edition", ["album"]),
    (text.title_tokens, "EP", ["ep"]),
    (text.want_keys, "D'Angelo, The Vanguard", ["dangelothevanguard", "dangelo"]),
    (text.clean_field, "Stand by Me", "Stand"),
    (text.plausible_score, "10.5", None),
    (text.plausible_score, "9.7", 9.7),
    (text.looks_like_name, "Homework", True),
    (text.looks_like_name, "home", False),
    (text.genre_from_filename, "lists/Pop__russian_rock__Indie.csv", "pop,russian rock,indie"),
    (text.genre_from_filename, "aquarium_1981.csv", "russian rock"),
    (text.url_key, "http://a.b/c?d", "http_a_b_c_d"),
])
def test_text(spark, make, value, expected):
    got = column(spark, value, make)
    assert sorted(got) == sorted(expected) if isinstance(expected, list) and make is text.want_keys else got == expected


def test_decode_bytes(spark):
    raw = spark.createDataFrame([(b"caf\xc3\xa9",), (b"\x93caf\xe9\x94",), (b"\x81",), (None,)], "b binary")
    assert [r[0] for r in raw.select(text.decode_bytes("b")).collect()] == ["café", "“café”", "\x81", None]


def test_token_difference_equals_counter(spark):
    rng = random.Random(3)
    rows = [([rng.choice("abc") for _ in range(rng.randint(0, 6))], [rng.choice("abc") for _ in range(rng.randint(0, 6))]) for _ in range(200)]
    got = spark.createDataFrame(rows, "a array<string>, b array<string>").select("a", "b", text.token_difference("a", "b").alias("d")).collect()
    assert all(Counter(x.split("#")[0] for x in r["d"]) == Counter(r["a"]) - Counter(r["b"]) for r in got)


@pytest.mark.parametrize("tag, bucket", [("pop rap", "Rap"), ("electropop", "Electronic"), ("trap", "Rap"), ("indie pop", "Rock")])
def test_buckets(spark, tag, bucket):
    assert column(spark, tag, lambda c: genres.bucket_of(F.col(c))) == bucket


@pytest.mark.parametrize("tag, fine", [("house", False), ("americana", False), ("1990s", False), ("seen live", False), ("Artist", False), ("punk", True)])
def test_genre_like(spark, tag, fine):
    assert column(spark, tag, lambda c: genres.is_genre_like(F.col(c), F.lit("artist"))) is fine


def test_flags(spark):
    rows = [(0, None, False), (1, None, False), (-1, None, False), (2, None, False), (-2, None, False), (None, None, False), (0, 1990, False), (0, None, True), (0, 0, False)]
    df = spark.createDataFrame(rows, "gap int, oy int, bnr boolean")
    re = reviews.reissue_flag(F.col("bnr"), F.col("oy"), F.col("gap"))
    got = [(r[0], r[1]) for r in df.select(re, reviews.new_release_flag(re, F.col("gap"))).collect()]
    assert got == [(False, True), (False, True), (False, True), (True, False), (False, False), (False, False), (True, False), (True, False), (False, True)]


def small_reviews(spark):
    rows = [
        ("a", "X", "One", 9.9, "1997-01-01", 1997, "Rap; Rock", "k1"), ("b", "X", "One", 10.0, "2017-01-01", 2017, "Folk", "k1"),
        ("c", "Y", "Two", 8.0, "1999-05-01", 1999, None, "k2"), ("d", "Y", "Two", 8.0, None, None, "Rap", "k2"),
        ("e", "Z", "Three", None, "1999-01-01", 1999, "Jazz", "k3"),
    ]
    return spark.createDataFrame(rows, "id string, artist string, album string, score double, review_date string, review_year int, genres string, _key string").withColumns(
        {"release_year": F.col("review_year"), "blurb": F.lit("b"), "reviewer": F.lit("r")})


def test_dedupe(spark):
    df = small_reviews(spark)
    kept = reviews.dedupe_albums(df)
    assert sorted(r["id"] for r in kept.collect()) == ["b", "c", "e"]
    assert sorted(r["id"] for r in reviews.dedupe_albums(kept).collect()) == ["b", "c", "e"]


def ids(df):
    return [r["id"] for r in df.collect()]


def test_selection(spark):
    df = small_reviews(spark)
    assert sorted(ids(select.select_reviews(df, Selection(genres=["rap", "jazz"])))) == ["a", "d"]
    assert sorted(ids(select.select_reviews(df, Selection(exclude_genres=["RAP"])))) == ["b", "c"]
    assert ids(select.select_reviews(df, Selection(search="x oNe b r", max_score=9.9))) == ["a"]
    assert sorted(ids(select.select_reviews(df, Selection(review_year="2012-2010")))) == ["a", "b", "c", "d"]
    with pytest.raises(ValueError):
        select.select_reviews(df, Selection(review_year="20x5"))
    assert ids(select.run_selection(df, Selection(sort="release")))[0] == "d"
    assert ids(select.run_selection(df, Selection(sort="date")))[-1] == "d"
    assert ids(select.sort_reviews(df, "random", 5)) == ids(select.sort_reviews(df.repartition(7), "random", 5))
    assert ids(select.run_selection(df, Selection(limit=2))) == ["b", "a"]


def test_genre_counts_and_histogram(spark):
    df = small_reviews(spark)
    assert {r["value"]: r["n"] for r in stats.genre_counts(df).collect()} == {"Rap": 2, "Rock": 1, "Folk": 1, "Jazz": 1, "(untagged)": 1}
    assert {r["bin"]: r["n"] for r in stats.histogram(df, "score", 4).collect()} == {1: 2, 4: 2}
    assert [r["bin"] for r in stats.histogram(df.filter("id = 'a'"), "score", 4).collect()] == [1]


def test_fill_genres(spark):
    df = small_reviews(spark).withColumn("genre", F.lit(None).cast("string"))
    tags = spark.createDataFrame([("Y", "Two", ["seen live"], ["post-punk", "jazz"])], "artist string, album string, album_tags array<string>, artist_tags array<string>")
    done = reviews.fill_genres(df, tags)
    assert {r["id"]: r["genres"] for r in done.collect()}["c"] == "Rock; Jazz"
    assert reviews.fill_counters(done).first().asDict() == {"missing": 1, "filled": 1, "unresolved": 0}
    assert not reviews.fill_genres(df, tags, limit=0).filter("filled").count()


PAGES = [
    ("19970601_t.html", "19970601", '<html><body><table><tr><td><a href="/1">Radiohead: OK Computer</a></td><td>10.0</td></tr>'
     '<tr><td><a href="/2">Modest Mouse: The Lonesome Crowded West</a></td><td>9.7</td></tr><tr><td>Click here</td><td>next page</td></tr></table></body></html>'),
    ("19970602_p.html", "19970602", "<html><body><h3>Yo La Tengo: I Can Hear the Heart Beating as One</h3><p>Reviewed by Ann Example</p>"
     "<p>Prose of 1997 with 12 songs.</p><p>Rating: 9.7</p><h3>Ween: The Mollusk</h3><p>More.</p><p>Rating: 9.7</p></body></html>"),
    ("19970603_s.html", "19970603", "<html><body><b>Daft Punk: Homework</b><br>text here<br>9.2 / 10<br></body></html>"),
    ("19990603_m.html", "19990603", "<!--\n1_artist: Low\n2_title: Secret Name\n3_label: Kranky\n4_rating: 8.7\n5_author: Bob Example\n-->"),
]


def test_extractors_and_vote(spark):
    pages = spark.createDataFrame(PAGES, "capture_file string, timestamp string, html string")

    def broken(html, body, name):
        raise RuntimeError("no")

    rows = extract.extract_records(pages, [*extract.EXTRACTORS, broken])
    found = extract.extracted(rows)
    got = Counter((r["extractor"], r["artist"], r["score"]) for r in found.collect())
    assert got == Counter([
        ("table_rows", "Radiohead", 10.0), ("table_rows", "Modest Mouse", 9.7), ("anchor_then_score", "Radiohead", 10.0), ("anchor_then_score", "Modest Mouse", 9.7),
        ("rating_label", "Yo La Tengo", 9.7), ("rating_label", "Ween", 9.7), ("heading_score", "Yo La Tengo", 9.7), ("heading_score", "Ween", 9.7),
        ("heading_score", "Daft Punk", 9.2), ("score_out_of_ten", "Daft Punk", 9.2), ("meta_comment", "Low", 8.7),
    ])
    assert rows.filter("artist IS NULL").count() == 4
    voted = candidates.collapse_candidates(found.filter("artist <> 'Low'")).collect()
    assert len(voted) == 5 and all((r["n_captures"], r["score_agreement"], r["confidence"], r["score_variants"]) == (2, 1.0, 1.0, None) for r in voted)
    assert {r["reviewer"] for r in voted if r["artist"] == "Ween"} == {"Ann Example Prose"}  # white space joins lines in the name pattern


def test_vote_confidence(spark):
    rows = [("f", 0, k, "table_rows", "Abba", "Bells", s, "1997-06", None, None) for k, s in enumerate([9.7, 9.7, 9.2])] + [("g", 0, 0, "x", "Cure", "Drums", 5.0, "1997-06", None, None)]
    df = spark.createDataFrame(rows, "capture_file string, extractor_idx int, pos int, extractor string, artist string, album string, score double, review_date_approx string, reviewer string, blurb string")
    got = {r["artist"]: r for r in candidates.collapse_candidates(df).collect()}
    assert (got["Abba"]["score"], got["Abba"]["score_agreement"], got["Abba"]["score_variants"], got["Abba"]["confidence"]) == (9.7, 0.67, [9.2, 9.7], 0.93)
    assert got["Cure"]["confidence"] == 0.8
    truth = spark.createDataFrame([("abba", "The Bells", 9.7, 1997), ("Cure", "Drums", 9.0, 1997), ("Eels", "Fog", 9.0, 1998)], "artist string, album string, score double, release_year int")
    found = candidates.collapse_candidates(df)
    assert {r["artist"]: r["status"] for r in candidates.compare_to_truth(found, truth).collect()} == {"abba": "hit", "Cure": "wrong_score", "Eels": "miss"}
    corpus = reviews.conform(spark.createDataFrame([("abba|bells",)], "_key string"))
    added = candidates.merge_candidates(found, corpus)
    assert [r["artist"] for r in added.collect()] == ["Cure"]
    assert candidates.merge_candidates(found, candidates.append_reviews(corpus, added)).count() == 0


CATALOGUE = [
    ("1", "Rival Dealer", ["Burial"], "album"), ("2", "Legends of Country Music: The Very Best", ["Bob Wills"], "album"),
    ("3", "Goodbye, Babylon", ["A Band"], "album"), ("4", "Goodbye Babylon", ["Dust Label"], "compilation"),
    ("5", "Voodoo", ["D'Angelo"], "album"), ("6", "Before Today", ["Ariel Pink"], "album"), ("7", "The End", ["Slowdive"], "album"),
    ("8", "Great Songs of Old Part Four", ["Bob Wills"], "album"), ("9", "Songs", ["Johnny Cash", "Willie Nelson"], "album"),
]
WANTS = [
    (1, "Burial", "Rival Dealer EP", "1"), (2, "Bob Wills", "Legends of Country Music", "2"), (3, "Various Artists", "Goodbye, Babylon", "4"),
    (4, "D'Angelo, The Vanguard", "voodoo", "5"), (5, "Ariel Pink's Haunted Graffiti", "Today Before", "6"), (6, "Low", "The End", None),
    (7, "Bob Wills", "Great Songs of Old", None), (8, "Johnny Cash and Willie Nelson", "Songs", "9"),
]


def test_matching(spark):
    catalogue = spark.createDataFrame([(*c, k) for k, c in enumerate(CATALOGUE)], "id string, name string, artists array<string>, album_type string, ordinal int")
    wants = spark.createDataFrame([w[:3] for w in WANTS], "want_id int, artist string, album string")
    best = {r["want_id"]: r["id"] for r in match.best_matches(wants, catalogue).collect()}
    assert best == {w[0]: w[3] for w in WANTS if w[3]}
    stored = wants.join(catalogue, F.col("want_id") == F.col("ordinal") + 1).drop("ordinal").withColumn("confidence", F.lit("old"))
    valid, stale = match.revalidate_matches(stored)
    assert {r["want_id"]: r["confidence"] for r in valid.collect()} == {1: "exact", 2: "fuzzy"} and stale.count() == 6


def test_contained_pairs_equal_brute_force(spark):
    rng = random.Random(5)
    words = "a b c d e f one 2 four".split()
    title = lambda: [rng.choice(words) for _ in range(rng.randint(1, 6))]
    w, c = [(k, title()) for k in range(60)], [(k, title()) for k in range(60)]

    def fits(x, y):
        short, long = (x, y) if len(x) <= len(y) else (y, x)
        extra = Counter(long) - Counter(short)
        return len(short) >= 3 and not Counter(short) - Counter(long) and not {t for t in extra if t.isdigit() or t in text.NUMBER_WORDS} - {"1"}

    got = match.contained_pairs(spark.createDataFrame(w, "want_id int, want_tokens array<string>"), spark.createDataFrame(c, "id int, tokens array<string>"))
    assert {(r[0], r[1]) for r in got.collect()} == {(a, b) for a, x in w for b, y in c if fits(x, y)}


def test_tracks_and_batches(spark):
    tracks = spark.createDataFrame([("x", 1, "t1", "n", 5), ("x", 2, "t2", "n", 7), ("x", 3, "t3", "n", 7)], "album_id string, track_no int, id string, name string, popularity int")
    assert match.best_track(tracks).first()["track_id"] == "t2"
    df = spark.range(250).withColumn("pos", F.col("id") * 3)
    got = match.assign_batches(df.repartition(5)).orderBy("pos").collect()
    assert [r["batch"] for r in got] == [k // 100 for k in range(250)]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "raw.json").write_text('[{"id": "1", "artist": "A", "title": "T", "url": "/r/1", "date": "1999-01-02", "releaseYear": 1999, "genres": ["Rap"], "score": 9.0}, {"id": "2"}]')
    (tmp_path / "enr.json").write_text('{"/r/1": {"country": "NA", "language": "en", "mbid": "m"}}')
    raw, enr = readers.read_reviews_json(spark, str(tmp_path / "raw.json")), readers.read_enrichment_json(spark, str(tmp_path / "enr.json"))
    built = reviews.format_reviews(reviews.build_reviews(raw, enr))
    first, second = built.collect()
    assert (first["country"], first["is_new_release"], first["_key"], first["genre"]) == ("NA", True, "a|t", "Rap")
    assert (second["artist"], second["genres"], second["review_year"], second["url"]) == ("Various Artists", "Untagged", None, "")
    sinks.write_selection(built, str(tmp_path / "tsv"))
    assert readers.read_reviews_tsv(spark, str(tmp_path / "tsv")).orderBy("id").first()["country"] == "NA"
    for date in ("2024-01-01", "2024-02-01"):
        sinks.write_snapshot(built.withColumn("image", F.lit(date)), str(tmp_path / "snap"), date)
    latest = readers.latest_snapshot(spark.read.parquet(str(tmp_path / "snap")), kind="prepared")
    assert {r["image"] for r in latest.collect()} == {"2024-02-01"}
    assert sinks.export_table(built).columns == sinks.EXPORT_COLUMNS
    assert sinks.export_markdown(built).orderBy(F.desc("value")).first()[0] == "| 9.0 | A | T | 1999 | Rap |"
    assert {r[0] for r in sinks.export_lines(built).collect()} == {"A - T", "Various Artists - "}
    folder = tmp_path / "caps"
    folder.mkdir()
    (folder / "19970601_a.html.gz").write_bytes(gzip.compress("<p>é</p>".encode()))
    cap = readers.read_captures(spark, str(folder)).first()
    assert (cap["timestamp"], cap["html"]) == ("19970601", "<p>é</p>")
    (tmp_path / "index.json").write_text('[["timestamp","original","digest","statuscode","mimetype"],["19970601000000","http://a/review/1","D","200","text/html"],["19970601000000","http://a/x","E","404","text/html"]]')
    index = readers.read_capture_index(spark, str(tmp_path / "index.json"))
    kept = captures.distinct_captures(captures.filter_captures(index))
    assert [r["url"] for r in kept.collect()] == ["http://a/review/1"]


SMALL = "/root/testdata/sf0.001"


def test_fuzzy_queries_equal_brute_force(spark, monkeypatch):
    report = queries._fuzzy_report(spark, SMALL).checkpoint()
    monkeypatch.setattr(queries, "_fuzzy_report", lambda *_: report)
    cut = lambda df, name, kind: df.withColumn("tokens", text.title_tokens(name)).withColumn("various", kind).collect()
    wanted = cut(views.wants(spark, SMALL), "album", F.col("artist") == "Various Artists")
    listed = cut(views.catalogue(spark, SMALL), "name", F.col("album_type") == "compilation")
    tracks = {}
    for t in views.tracks(spark, SMALL).collect():
        tracks[t["album_id"]] = min(tracks.get(t["album_id"], (1,)), (-t["popularity"], t["track_no"], t["id"]))

    def contained(x, y):
        short, long = (x, y) if len(x) <= len(y) else (y, x)
        extra = Counter(long) - Counter(short)
        return len(short) >= 3 and not Counter(short) - Counter(long) and not {t for t in extra if t.isdigit() or t in text.NUMBER_WORDS} - {"1"}

    want = {}
    for w in wanted:
        fits = [c for c in listed if c["various"] and w["various"] or not c["various"] and not w["various"] and c["artists"] == [w["artist"]]]
        found = [(Counter(c["tokens"]) != Counter(w["tokens"]), c["ordinal"], c["id"]) for c in fits if Counter(c["tokens"]) == Counter(w["tokens"]) or contained(w["tokens"], c["tokens"])]
        kind, track = (("fuzzy" if min(found)[0] else "exact"), tracks.get(min(found)[2])) if found else (None, None)
        want[w["want_id"]] = (track is not None, kind, track and track[2], -track[0] if track else -1)
    got = {r["want_id"]: tuple(r)[1:] for r in queries.match_report(spark, SMALL).collect()}
    assert got == want
    fuzzy = {k for k, v in want.items() if v[1] == "fuzzy"}
    assert fuzzy and fuzzy == {k for k in want if k % 7 == 0}
    first = {}
    for k in sorted(want):
        if want[k][0]:
            first.setdefault(want[k][2], k)
    assert {tuple(r) for r in queries.track_list(spark, SMALL).collect()} == set(first.items())
    assert tuple(queries.match_summary(spark, SMALL).first()) == (len(want), sum(v[0] for v in want.values()), len(fuzzy), len(first))
    order = {t: n for n, t in enumerate(sorted(first, key=first.get))}
    assert {(r["track_id"], r["ordinal"], r["batch"]) for r in queries.delivery_batches(spark, SMALL).collect()} == {(t, n, n // 100) for t, n in order.items()}


@pytest.mark.parametrize("how, key", [
    ("score", lambda r: (-r["score"], r["artist"], r["id"])), ("score_asc", lambda r: (r["score"], r["artist"], r["id"])),
    ("date", lambda r: (r["review_date"], r["artist"], r["id"])), ("artist", lambda r: (r["artist"].lower(), r["album"].lower(), r["id"])),
])
def test_full_sorts_keep_every_row(spark, how, key):
    rows = queries.QUERIES[f"full_sort_{how}"](spark, SMALL).collect()
    assert len(rows) == views.table(spark, SMALL, "lineitem").count() > 200 and rows == sorted(rows, key=key)


def test_whole_texts_equal_brute_force(spark, tmp_path):
    texts = ["if (a &amp;&amp; b) { c; }", "A &amp;lt;b&gt;  c\n d ;", "plain  text", "x & y; z", "The Caf&eacute; (live) and é EP", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").write.parquet(str(tmp_path / "documents.parquet"))
    pages = [f"<p>{' ' * n}{'-' * m}Title {n} - by Ann Example</p>" for n, m in ((0, 0), (3, 150), (0, 260))]
    spark.createDataFrame(list(enumerate(pages)), "page_id int, html string").write.parquet(str(tmp_path / "pages.parquet"))
    clean = {k: re.sub(r"\s+", " ", html.unescape(html.unescape(t or ""))).strip() for k, t in enumerate(texts)}
    assert {r["doc_id"]: r["clean"] for r in queries.clean_texts(spark, str(tmp_path)).collect()} == clean
    plain = [re.sub(r"\(.*?\)", " ", unicodedata.normalize("NFKD", (t or "").lower())) for t in texts]
    loose = {k: re.sub("[^a-z0-9]+", "", re.sub(r"\b(the|a|an|ep|lp|and)\b", " ", t)) for k, t in enumerate(plain)}
    assert {r["doc_id"]: r["loose"] for r in queries.loose_keys_full(spark, str(tmp_path)).collect()} == loose
    heads = {r["page_id"]: r["head"] for r in queries.page_texts(spark, str(tmp_path)).collect()}
    assert heads == {0: "Title 0", 1: "Title 3", 2: "Title 0"}


def test_whole_truth_has_every_part(spark):
    part = views.table(spark, SMALL, "part").select("p_brand", "p_name").distinct().count()
    got = Counter(r["status"] for r in queries.compare_to_truth(spark, SMALL).collect())
    assert sum(got.values()) == part and min(got["hit"], got["wrong_score"], got["miss"]) > 0


# --- byte ranges of JSON, containment by sets, pages by bytes ----------------------------------------


def test_json_members_of_every_cut(spark, tmp_path):
    """Any range size gives the same members: strings with brackets, quotes and runs of backslashes, long and empty members."""
    from platter.sources import members

    values = [{"a": '"],["'}, [1, [2, {"b": "}{"}]], "x\\\\", '\\"', "é日😀", 7, None, {}, "y" * 300, "\\" * 41, [","]]
    (tmp_path / "array.json").write_text(json.dumps(values, ensure_ascii=False))
    (tmp_path / "two.json").write_text(json.dumps(values[:3]) + "\n" + json.dumps(values[3:], indent=2))
    (tmp_path / "object.json").write_text("﻿" + json.dumps({f"k{n}\"{{": v for n, v in enumerate(values)}, indent=1))
    (tmp_path / "none.json").write_text(" [ ] ")
    for size in (1, 2, 3, 7, 64, 1 << 20):
        for name in ("array", "two"):
            path, total = str(tmp_path / f"{name}.json"), (tmp_path / f"{name}.json").stat().st_size
            cuts = [(s, min(s + size, total)) for s in range(0, total, size)]
            in_string, depth, found = False, 0, []
            for s, e in cuts:
                found += members.range_members(path, s, e, in_string, depth)
                odd, outside, inside = members.range_state(path, s, e)
                depth, in_string = depth + (inside if in_string else outside), in_string ^ bool(odd)
            assert [json.loads(m) for m in found] == values and depth == 0 and not in_string
    got = [json.loads(r[0]) for r in members.json_members(spark, str(tmp_path / "object.json"), 37).collect()]
    assert sorted(map(repr, got)) == sorted(repr({f"k{n}\"{{": v}) for n, v in enumerate(values))
    assert members.json_members(spark, str(tmp_path / "none.json"), 2).count() == 0
    assert members.json_members(spark, str(tmp_path / "array.json"), 100).rdd.getNumPartitions() > 2


def test_capture_index_reader_filters(spark, tmp_path):
    from platter.sources import members

    rows = [[f"{1996 + k % 5}0101", f"http://a/{k}", None if k % 7 == 0 else "D", "200" if k % 3 else "404", "text/html"] for k in range(200)]
    (tmp_path / "index.json").write_text(json.dumps([["timestamp", "original", "digest", "statuscode", "mimetype"], *rows]))
    wanted = sorted(tuple(map(str, r)) for r in rows if r[3] == "200" and "1997" <= r[0] < "1999")
    condition = "statuscode = '200' AND timestamp >= '1997' AND timestamp < '1999' AND original LIKE 'http%'"
    for pushed in ("true", "false"):
        spark.conf.set("spark.sql.python.filterPushdown.enabled", pushed)
        try:
            index = readers.read_capture_index(spark, str(tmp_path / "index.json"), 500)
            assert index.rdd.getNumPartitions() > 2
            assert sorted(tuple(map(str, r)) for r in index.filter(condition).collect()) == wanted
        finally:
            spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    reader = members.FilteringReader({"plan": "[]"})
    left = list(reader.pushFilters([members.EqualTo(("statuscode",), "200"), members.EqualTo(("digest",), "D"), members.LessThan(("timestamp",), "1999")]))
    assert [f.attribute for f in left] == [("digest",)] and reader.tests == [(3, "=", "200"), (0, "<", "1999")]


def test_containment_blocks_and_wide_titles(spark, monkeypatch):
    """Hot entries cut into small blocks, and titles beyond the width of pairs, lose and repeat nothing."""
    rng = random.Random(8)
    words = [f"w{k}" for k in range(12)]
    title = lambda: rng.sample(words, rng.randint(1, 5)) if rng.random() < 0.8 else [rng.choice(words) for _ in range(rng.randint(15, 40))]
    w, c = [(k, title()) for k in range(120)], [(k, title()) for k in range(120)]
    expected = {(a, b) for a, x in w for b, y in c if min(len(x), len(y)) >= 3 and not (Counter(min(x, y, key=len)) - Counter(max(y, x, key=len)))}
    wants = spark.createDataFrame(w, "want_id int, want_tokens array<string>")
    albums = spark.createDataFrame(c, "id int, tokens array<string>")
    sides = match._rows_as_sets(wants, "want_tokens", [], 3), match._rows_as_sets(albums, "tokens", [], 3)
    found = match.contained_sets(*sides, [], item=3)
    assert found.count() == found.distinct().count()
    pairs = sides[0].withColumnRenamed("title", "want").join(found, "want").join(sides[1].withColumnRenamed("title", "album"), "album")
    assert {(r["want_id"], r["id"]) for r in pairs.collect()} == expected
    load = match.containment_load(wants, albums, item=3).first()
    assert load["largest_item"] <= 8 * 8 and load["want_sets"] <= 120


def test_containment_grows_with_its_input(spark):
    """Twenty words for any number of titles: ten times the parts give no more candidates than distinct titles allow."""
    rng = random.Random(9)
    words = [f"w{k}" for k in range(20)]
    title = lambda: " ".join(rng.choices(words, k=rng.randint(3, 5)))
    loads = []
    for n in (300, 3000):
        rows = [(k, title().split()) for k in range(n)]
        df = spark.createDataFrame(rows, "want_id int, want_tokens array<string>")
        albums = spark.createDataFrame(rows, "id int, tokens array<string>")
        loads.append(match.containment_load(df, albums).first())
    assert loads[1]["want_sets"] <= 3000 and loads[0]["candidates"] < 6 * loads[0]["want_sets"] and loads[1]["candidates"] < 40 * loads[1]["want_sets"]
    assert loads[1]["largest_item"] <= 1024 * 1024


def test_pages_are_cut_by_bytes(spark):
    from platter.operators import steps

    import pyarrow as pa

    sizes = [10, 5000, 10, 10, 90, 4, 0, 7]
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in sizes]), pa.array([None, *"abcdefg"])], ["html", "text"])
    parts = list(steps.byte_slices(batch, ("html", "text"), 100))
    assert [p.num_rows for p in parts] == [2, 3, 3] and pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist()
    pages = spark.createDataFrame([(*p[:2], p[2] + " " * (k * 3000)) for k, p in enumerate(PAGES * 5)], "capture_file string, timestamp string, html string")
    whole = extract.extract_records(pages)
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(whole) == key(extract.extract_records(pages, slice_bytes=1))


def test_interleaved_alternatives(spark):
    """A record's first fine choice counts, in whatever order an extractor yields them; equal pages stay apart."""
    from platter.operators.extract import Found

    def mixed(html, body, name):
        yield Found("5.0", "Second Band: Songs", number=2, choice=1)
        yield Found("5.0", "First Band: Songs", number=1, choice=1)
        yield Found("5.0", "search: Home", number=1, choice=0)
        yield Found("5.0", "Other Band: Tunes", number=2, choice=0)

    pages = spark.createDataFrame([("f", "1997", "x")] * 3, "capture_file string, timestamp string, html string").coalesce(1)
    got = Counter((r["artist"], r["pos"]) for r in extract.extract_records(pages, [mixed]).collect())
    assert got == Counter({("First Band", 1): 3, ("Other Band", 2): 3})


def test_json_ranges_stay_few(spark, tmp_path, monkeypatch):
    """A split far below the input's size makes longer ranges, not more, and no range reads much past its end."""
    import json

    from platter.sources import members

    rows = [{"n": k, "t": '"[,\\'} for k in range(2000)]
    (tmp_path / "many.json").write_text(json.dumps(rows))
    monkeypatch.setattr(members, "MOST_RANGES", 8)
    plan = members.planned_ranges(spark, str(tmp_path / "many.json"), 10)
    assert 2 < len(plan) <= 9
    found = members.json_members(spark, str(tmp_path / "many.json"), 10)
    assert found.rdd.getNumPartitions() <= 8
    assert sorted(json.loads(r[0])["n"] for r in found.collect()) == list(range(2000))
    with members.opened(str(tmp_path / "many.json")) as file:
        assert len(next(members._chunks(file, 5, 105, on=True))) == 100


def test_page_text_in_a_task_equals_the_column(spark):
    """``stripped`` and ``reviewer_of`` give what the column functions give, and extraction keeps few Python steps."""
    from platter.functions import text
    from platter.operators import extract

    pages = ["", " a b c ", "<SCRIPT x>1</script>a<br/>b</P >\n \n　\nc", "<p>x &amp;lt;b&amp;gt; &nbsp; y</p>\x1c\n\x1c\nz\x1c", "by Ann O'Neil-Smith Lee", "<p>reviewed by Ann B. Example, who</p>", "<style>a</ſtyle>b</style>c\x85 ", "a < b > c <unclosed"]
    frame = spark.createDataFrame(list(enumerate(pages)), "k int, html string").repartition(1)
    column = text.strip_tags("html").alias("t")
    for row in frame.select("html", column).collect():
        assert text.stripped(row["html"]) == row["t"], row["html"]
    for row in frame.select(column).select("t", text.find_reviewer("t").alias("r")).collect():
        assert (text.reviewer_of(row["t"]) or None) == row["r"]
    captures = frame.select(F.col("k").cast("string").alias("capture_file"), F.lit("1998").alias("timestamp"), "html")
    plan = extract.extract_records(captures)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("MapInArrow") <= 3
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20


def test_records_of_a_long_page_leave_in_batches(spark):
    """A page's length bounds no batch: records leave ``SLICE_ROWS`` at a time and are chosen as before."""
    import pyarrow as pa

    count = 3 * extract.SLICE_ROWS // 2
    page = "\n".join(f'<tr><td><a href="/r">Band: Album {k}</a></td><td>{k % 10}.0</td></tr>' for k in range(count))
    own = [extract.table_rows, extract.anchor_then_score]

    class Pages:
        """Hands out what would run in a task."""

        sparkSession = spark
        select = lambda self, *columns: self
        mapInArrow = lambda self, run, schema: run

    run = extract.rough_records(Pages(), own)
    sizes = [b.num_rows for b in run(iter([pa.RecordBatch.from_pydict({"capture_file": ["a", "b"], "timestamp": ["1998"] * 2, "html": [page] * 2})]))]
    assert max(sizes) <= extract.SLICE_ROWS and sum(sizes) == 4 * count
    pages = spark.createDataFrame([("a", "1998", page), ("b", "1998", page)], "capture_file string, timestamp string, html string").coalesce(1)
    found = extract.extract_records(pages, own).groupBy("capture_file", "extractor").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("album").alias("d"))
    assert sorted(map(tuple, found.collect())) == sorted((c, e.__name__, count, count) for c in "ab" for e in own)


def test_extraction_keeps_two_python_steps(spark):
    """Entities are resolved where pages are read: a task holds the workers of two Python steps, and fields come out as ``clean_field`` has them."""
    from platter.functions import text
    from platter.operators.extract import Found

    labels = ["A &amp; B: C &amp;amp; D", "Caf&eacute;&#58; x: y &#8211;", "No colon", ": lead", "Two: Parts: of &lt;it&gt;", "", "R&B: T&nbsp;x by Ann"]

    def labelled(html, body, name):
        yield from (Found("5.0", label, markup=k % 2 == 1, as_cleaned=True, reviewer="Ann &amp; Bob", publisher=" L&eacute;g ") for k, label in enumerate(labels))
        yield Found("5.0", None, artist="Own &amp; Artist", as_cleaned=True, album="Own Album")
        yield Found("5.0", "Label: Album", artist="Own Artist", as_cleaned=True)

    pages = spark.createDataFrame([("f", "1997", "by Ann O'Neil Lee")], "capture_file string, timestamp string, html string").coalesce(1)
    rows = extract.extract_records(pages, [labelled])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("MapInArrow") == 2
    found = [text.stripped(label) if k % 2 else label for k, label in enumerate(labels)]
    want = [(k, *(x if colon else (None, None))) for k, label in enumerate(found) for a, colon, b in [label.partition(":")] for x in [(a, b)]]
    want += [(len(labels), "Own &amp; Artist", "Own Album"), (len(labels) + 1, "Own Artist", " Album")]
    frame = spark.createDataFrame(want, "pos int, a string, b string").filter("b IS NOT NULL")
    cleaned = frame.select("pos", text.clean_field("a").alias("a"), text.clean_field("b").alias("b")).filter(text.looks_like_name("a") & text.looks_like_name("b"))
    got = [(r["pos"], r["artist"], r["album"]) for r in rows.orderBy("pos").collect()]
    assert got == sorted(map(tuple, cleaned.collect())) and len(got) >= 5
    assert {(r["reviewer"], r["label"]) for r in rows.filter("pos < 7").collect()} == {("Ann & Bob", "L\u00e9g")}
    assert {(r["reviewer"], r["label"]) for r in rows.filter("pos >= 7").collect()} == {("Ann O'Neil Lee", None)}


def test_votes_compute_keys_in_one_python_step(spark, monkeypatch):
    """Keys and the condition on them are one Python step: a task of extraction and votes holds three workers."""
    kept, settled = [], candidates.settled
    monkeypatch.setattr(candidates, "settled", lambda df: kept.append(df) or settled(df))
    page = "".join(f'<tr><td><a href="/r">{label}</a></td><td>5.0</td></tr>' for label in ("Ween: Mollusk", "The Ween: Mollusk EP", "Ween: The and", "The A: Mollusk"))
    pages = spark.createDataFrame([("f", "1997", page)], "capture_file string, timestamp string, html string")
    found = candidates.collapse_candidates(extract.extracted(extract.extract_records(pages)))
    plan = kept[0]._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("ArrowEvalPython"), plan.count("MapInArrow")) == (1, 2)
    assert [(r["key_artist"], r["key_album"], r["n_captures"]) for r in found.collect()] == [("ween", "mollusk", 4)]


@pytest.mark.parametrize("name", [
    "misses_by_year_whole",
    "score_disagreements",
    "append_reviews",
    "already_known_filtered",
    "unverified_candidates_whole",
    "compare_to_whole_truth",
])
def test_queries_on_votes_hold_three_workers_a_task(spark, monkeypatch, name):
    """The step that reads the pages has three Python steps, the keys being one of them."""
    kept = []
    monkeypatch.setattr(candidates, "settled", lambda df: kept.append(df) or spark.createDataFrame([], df.schema))
    queries.QUERIES[name](spark, SMALL)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in kept]
    assert [(p.count("ArrowEvalPython"), p.count("MapInArrow")) for p in plans] == [(1, 2)]
