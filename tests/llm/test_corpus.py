"""Corpus operators against brute force, round trips and held-out accuracy, with edge cases."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabforge.llm import (
    components, exact_dedup, html_main, jaccard_join, language_mix, line_dedup, packing,
    prefix_forest, queries, rule_quality, sentencepiece_scan, token_counts,
)
from tabforge.llm.tokens import byte_level_encoder

WORDS = "alpha beta gamma delta omega sigma kappa lambda theta iota".split()


@pytest.fixture
def docs(spark):
    """Documents from texts; null, empty, repeated and clashing columns are added."""
    def build(texts, ids=None):
        rows = list(zip(ids or range(len(texts)), texts))
        return spark.createDataFrame(rows, "doc_id long, text string").withColumns({
            c: F.lit(None).cast("string") for c in (
                "digest", "id", "key", "kept", "line", "score", "piece", "length", "w")})
    return build


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


# ---- 1 token counts ------------------------------------------------------------------------


def test_token_trees_follow_edits(spark, docs):
    rng = random.Random(3)
    encode = byte_level_encoder(queries.BYTE_BPE)
    texts = [prose(rng, 300), "", None, "it's  a\n\n\ttest 12345!", "x" * 3000, "é🙂 漢字 " * 200]
    expected, rows = {}, []
    for i, text in enumerate(texts):
        now = text or ""
        for seq in range(6):
            a = rng.randrange(len(now) + 1)
            b = min(len(now), a + rng.choice([0, 1, 30, 500]))
            new = rng.choice(["", " ", "word", "'s a\n", prose(rng, 80)])
            rows.append((i, seq, a, b, new))
            now = now[:a] + new + now[b:]
        expected[i] = now
    edits = spark.createDataFrame(rows, "doc_id long, seq int, start int, end int, replacement string")
    trees = token_counts.segment_trees(docs(texts), queries.BYTE_BPE)
    out = token_counts.apply_edits(token_counts.with_edits(trees, edits), queries.BYTE_BPE).collect()
    assert {r.doc_id: r.text for r in out} == expected
    assert all(r.n_tokens == len(encode(r.text)) for r in out)
    assert all(r.n_before == len(encode(texts[r.doc_id] or "")) for r in out)
    assert all(sum(r.leaf_chars) == len(r.text) for r in out)


def test_one_edit_encodes_a_small_part(docs):
    text = prose(random.Random(1), 5000)
    trees = token_counts.segment_trees(docs([text]), queries.BYTE_BPE).withColumn("edits", F.array(
        F.struct(F.lit(20_000).alias("start"), F.lit(20_004).alias("end"),
                 F.lit("new").alias("replacement"))))
    row = token_counts.apply_edits(trees, queries.BYTE_BPE).first()
    assert row.encoded_chars < 1500 < len(text)


# ---- 2 main text ---------------------------------------------------------------------------


def test_cut_is_minimal():
    rng = random.Random(5)
    for _ in range(150):
        n = rng.randint(1, 8)
        score = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 1.5)) for a in range(n) for b in range(a + 1, n)
                 if rng.random() < 0.5]

        def cost(side):
            return (sum(max(0, -s) if c else max(0, s) for s, c in zip(score, side))
                    + sum(w for a, b, w in edges if side[a] != side[b]))

        least = min(cost(side) for side in itertools.product([False, True], repeat=n))
        assert cost(html_main.minimum_cut(score, edges)) == pytest.approx(least, abs=1e-6)


PAGE = """<body><header><p>The best site of the whole web.</p></header><nav><a href=/>Home</a></nav>
<div class="cookie-notice"><p>We use cookies to make this site better for you.</p></div>
<article><h1>Title &amp; more</h1><p>First  paragraph<br>with a <a href=x>link</a> and text.
<div class="ad"><p>Buy this great product, it is cheap.</p></div><p>Te.</p></article>
<section id="comments"><p>I liked this article very much, thanks a lot.</p></section>
<form><p>Send us your address, please.</p></form><aside><p>Other stories that you may like.</p></aside>
<footer><p>Copyright, all rights reserved.</p></footer><script>"<p>no</p>"</script>"""


def test_main_text(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", PAGE), (None, "u", "<p>Just one plain paragraph here.")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "text", F.lit("clash"))
    out = {r.page_id: r.text for r in html_main.extract(pages).collect()}
    assert out[1] == out[4] == "Title & more\nFirst paragraph with a link and text.\nTe."
    assert out[2] == out[3] == "" and out[None] == "Just one plain paragraph here."
    assert html_main.extract(pages.limit(0)).count() == 0


# ---- 3 SentencePiece -----------------------------------------------------------------------


def test_chunks_give_the_ids_of_the_library(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE)
    rng = random.Random(9)
    texts = [prose(rng, 200), "", None, "the" * 300, "   a   b " * 30, "漢🙂e\n" * 90, "x y"]
    for size in (7, 64):
        encoded = sentencepiece_scan.encode(docs(texts), queries.PIECE_BPE, chunk=size)
        ids, back = defaultdict(list), defaultdict(str)
        for r in encoded.orderBy("doc_id", "chunk").collect():
            ids[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
        for r in sentencepiece_scan.decode(encoded, queries.PIECE_BPE).orderBy("doc_id", "chunk").collect():
            back[r.doc_id] += r.text
        for i, text in enumerate(texts):
            assert ids[i] == library.encode(text or "")
            assert back[i] == (text or "")


# ---- 4 exact deduplication -----------------------------------------------------------------


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, lambda t: F.length(t).cast("string")])
def test_exact_duplicates(docs, digest):
    texts = ["a", "b", "a", None, "", "A", "a" * 50_000, "a"]
    out = exact_dedup.exact_duplicates(docs(texts), digest=digest, salts=2).collect()
    keep = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in out}
    assert keep == {0: (7, 3, False), 2: (7, 3, False), 7: (7, 3, True), 1: (1, 1, True),
                    3: (4, 2, False), 4: (4, 2, True), 5: (5, 1, True), 6: (6, 1, True)}
    assert sorted(r.doc_id for r in exact_dedup.deduplicate(docs(texts)).collect()) == [1, 4, 5, 6, 7]


def test_exact_duplicates_odd_rows(docs):
    out = exact_dedup.exact_duplicates(docs(["a", "a", "a", "b"], [1, 1, None, None])).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out) == Counter({
        (1, 1, 3, True): 2, (None, 1, 3, False): 1, (None, None, 1, True): 1})
    assert exact_dedup.exact_duplicates(docs(["a"]).limit(0)).count() == 0


# ---- 5 Jaccard join ------------------------------------------------------------------------


def brute_components(texts, width, num, den):
    sets = {}
    for i, text in texts.items():
        words = (text or "").encode().lower().split()
        k = min(width, len(words))
        sets[i] = {tuple(words[j:j + k]) for j in range(len(words) - k + 1)} if k else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("seed,rounds", [(1, 2), (2, 0)])
def test_jaccard_components(docs, seed, rounds):
    rng = random.Random(seed)
    texts = ["", None, " \t\n", "One two", "one TWO", "one two three four", "a b c d e", "a b c d"]
    for length in (5, 8, 12, 30, 90, 200):
        base = prose(rng, length).split()
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randrange(1 + length // 12)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            texts.append(" ".join(copy[rng.randrange(2):]))
    found = jaccard_join.similar_components(docs(texts + texts[:1]), hub_rounds=rounds).collect()
    expected = brute_components(dict(enumerate(texts + texts[:1])), 4, 85, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_jaccard_odd_rows(docs):
    found = jaccard_join.similar_components(docs(["a b c d e"] * 4, [3, 3, None, 1])).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (3, 1)]
    assert jaccard_join.similar_components(docs(["a"]).limit(0)).count() == 0


def test_jaccard_copies_are_not_paired(docs, monkeypatch):
    """Two texts that meet but do not link make one pair, however many copies there are of both."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    other = words[:270] + prose(rng, 30).split()  # 267 of 327 shingles in common, 0.82
    near = words[:296] + prose(rng, 4).split()
    texts = [" ".join(x) for x in (words, other) for _ in range(40)] + [" ".join(near), "", ""]
    made, real = [], jaccard_join._similar

    def similar(pairs, *rest):
        made.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "_similar", similar)
    found = jaccard_join.similar_components(docs(texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(
        dict(enumerate(texts)), 4, 85, 100)
    assert sum(made) <= 3  # of three different texts


def test_bits_bound_the_difference():
    rng = random.Random(4)
    for _ in range(50):
        a, b = (jaccard_join.shingle_set(prose(rng, 60), 2) for _ in "ab")
        bits = [jaccard_join.parity_bits(x).view(np.uint64) for x in (a, b)]
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(a, b))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(20, 50)] + [(100, i) for i in range(101, 140)] + [(7, 7), (3, 1)]
    found = components.connected_components(spark.createDataFrame(edges, "x long, y long"))
    got = {r.id: r.component for r in found.collect()}
    assert got == {**{i: 20 for i in range(21, 51)}, **{i: 100 for i in range(101, 140)}, 3: 1}


# ---- 6 language ----------------------------------------------------------------------------


def test_language_held_out_accuracy(spark, sf):
    out = queries.QUERIES["op6_language_id"](spark, sf)
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = out.filter("held_out").join(documents, "doc_id")
    assert held.filter("lang = lang_pred").count() / held.count() > 0.95
    assert out.filter("score < 0 OR score > 1").count() == 0


def test_language_edges(docs):
    known = docs(["the cat and the dog " * 9, "der hund und die katze " * 9, "x"], [1, 2, 3])
    known = known.withColumn("lang", F.expr("element_at(map(1, 'en', 2, 'de'), cast(doc_id AS int))"))
    model = language_mix.train(known)
    assert model.languages == ["de", "en"]
    asked = docs([None, "", "12 ?!", "the dog", "der hund und die katze", "the cat and the dog " * 4000])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_mix.predict(asked, model).collect()}
    assert [got[i] for i in range(3)] == [("und", 0.0)] * 3
    assert [got[i][0] for i in (3, 4, 5)] == ["en", "de", "en"]
    none = language_mix.train(known.limit(0))
    assert {r.lang_pred for r in language_mix.predict(asked, none).collect()} == {"und"}
    mixed = language_mix.predict(docs(["der hund und die katze " * 20 + "the cat and the dog " * 10]), model)
    assert mixed.first().languages == ["de", "en"]


# ---- 7 lines -------------------------------------------------------------------------------


def test_lines_against_brute_force(docs):
    rng = random.Random(8)
    lines = [prose(rng, n).split() for n in (2, 3, 9, 10, 11, 14, 40)]
    texts = []
    for _ in range(40):
        made = []
        for line in rng.sample(lines, 4):
            words = list(line)
            for _ in range(rng.choice([0, 1, 1, 2])):
                at = rng.randrange(len(words))
                words[at:at + rng.randrange(2)] = [rng.choice(WORDS)] * rng.randrange(2)
                words = words or ["x"]
            made.append("  ".join(words).title())
        texts.append("\n".join(made))
    texts += [None, "", "\n\n"]
    cut = {(i, j): re.sub(r"\s+", " ", x.lower()).strip().split(" ")
           for i, t in enumerate(texts) for j, x in enumerate((t or "").split("\n"))}
    keys = sorted(k for k in cut if len(cut[k]) >= 3)

    def near(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < 10 or abs(len(a) - len(b)) > 1:
            return False
        rest = lambda x: {(i, *x[:i], *x[i + 1:]) for i in range(len(x))}
        if len(a) == len(b):
            return bool(rest(a) & rest(b))
        short, long = sorted((a, b), key=len)
        return any(long[:i] + long[i + 1:] == short for i in range(len(long)))

    expected = {k for n, k in enumerate(keys) if any(near(cut[k], cut[e]) for e in keys[:n])}
    found = line_dedup.duplicate_lines(docs(texts)).collect()
    assert {(r.doc, r.line) for r in found} == expected
    assert all(near(cut[r.doc, r.line], cut[r.keep_doc, r.keep_line]) for r in found)
    kept = {r.doc_id: r.text for r in line_dedup.without_duplicate_lines(docs(texts)).collect()}
    for i, text in enumerate(texts):
        rest = [x for j, x in enumerate((text or "").split("\n")) if (i, j) not in expected]
        assert kept.get(i, "gone") == (text if text is None else "\n".join(rest) if rest else "gone")


def test_lines_odd_rows(docs):
    out = line_dedup.dedup_report(docs(["one two three"] * 3, [5, 5, None])).collect()
    assert [r.n_dropped for r in out] == [0, 0, 0]
    assert line_dedup.dedup_report(docs(["a"]).limit(0)).count() == 0


def word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_longer_lines_may_differ_in_more_words(docs):
    rng = random.Random(5)
    bases = [prose(rng, n).split() for n in (9, 12, 19, 20, 21, 29, 31, 50)]
    lines = []
    for _ in range(150):
        words = list(rng.choice(bases))
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(words) + 1)
            words[at:at + rng.randrange(2)] = [prose(rng, 1)] * rng.randrange(2)
        lines.append(" ".join(words))
    texts = ["\n".join(lines[i:i + 5]) for i in range(0, len(lines), 5)]
    cut = {(i, j): x.split() for i, t in enumerate(texts) for j, x in enumerate(t.split("\n"))}
    keys = sorted(cut)

    def near(a, b):
        return word_edits(a, b) <= sum(min(len(a), len(b)) >= n for n in (10, 20, 30))

    expected = {k for n, k in enumerate(keys) if any(near(cut[k], cut[e]) for e in keys[:n])}
    found = line_dedup.duplicate_lines(docs(texts), more_edits=(20, 30)).collect()
    assert {(r.doc, r.line) for r in found} == expected
    one = {(r.doc, r.line) for r in line_dedup.duplicate_lines(docs(texts)).collect()}
    assert one < expected
    for r in found:
        a, b = cut[r.doc, r.line], cut[r.keep_doc, r.keep_line]
        assert (r.keep_doc, r.keep_line) < (r.doc, r.line) and near(a, b)
        assert r.distance == word_edits(a, b)


def test_wider_line_bounds_cut_only_likely_lines_in_parts(docs, monkeypatch):
    rng = random.Random(11)

    def words(n):
        return ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(n)]

    def edited(line, d):
        line = list(line)
        for at in rng.sample(range(len(line)), d):
            line[at] = words(1)[0]
        return line

    lone = [words(rng.randrange(50, 80)) for _ in range(300)]
    bases = [words(n) for n in (20, 25, 32, 33, 45, 60) for _ in range(5)]
    nears = [edited(x, 3 if len(x) >= 30 else 2) for x in bases]
    seen, further = [], line_dedup._further

    def counted(lines, *rest):
        seen.append(lines.count())
        return further(lines, *rest)

    monkeypatch.setattr(line_dedup, "_further", counted)
    texts = ["\n".join(" ".join(x) for x in lone + bases), "\n".join(" ".join(x) for x in nears)]
    found = line_dedup.duplicate_lines(docs(texts), more_edits=(20, 30)).collect()
    assert {(r.doc, r.line, r.keep_doc, r.keep_line) for r in found} == {
        (1, i, 0, len(lone) + i) for i in range(len(nears))}
    # Nearly all of the lone lines never come to it.
    assert len(nears) + len(bases) <= seen[0] < 100


def test_short_lines_leave_no_stubs(spark, docs):
    words = "one two three four"
    texts = [words + "\nHaanth.\n\n漢字かな交じり文", words + "\n\nhaanth.", "漢字かな交じり文\nnew",
             words + "\n \t\n", "", "\n\n", None, "Yes"]
    out = corpus_pipeline.line_stage(spark, docs(texts), None).collect()
    assert {r.doc_id: r.text for r in out} == {
        0: texts[0], 2: "new", 4: "", 5: "\n\n", 6: None, 7: "Yes"}


# ---- 8 neighbours --------------------------------------------------------------------------


def test_recall(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = vectors.collect()
    ids = np.array([r.vec_id for r in rows])
    held = np.array([r.embedding for r in rows], dtype=float)
    found = defaultdict(list)
    for r in queries.QUERIES["op8_nearest_neighbours"](spark, sf).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r)
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        scores = held @ held[q]
        best = [ids[i] for i in np.lexsort((ids, -scores)) if i != q][:20]
        got = found[ids[q]]
        hits.append(len(set(best) & {r.vec_id for r in got}) / 20)
        assert [r.rank for r in got] == list(range(1, len(got) + 1))
        assert got == sorted(got, key=lambda r: (-r.score, r.vec_id))
        assert all(r.score == pytest.approx(scores[ids == r.vec_id][0], abs=1e-12) for r in got)
    assert np.mean(hits) >= 0.9


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, None), (5, [0.0, 0.0]),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (0, [1.0, 0.0]), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = prefix_forest.nearest(vectors, vectors.filter("vec_id = 0 OR vec_id > 3"), k=20)
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in out.orderBy("rank").collect()] == [
        (0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.0)]
    assert prefix_forest.nearest(vectors.limit(0), vectors).count() == 0
    assert prefix_forest.nearest(vectors, vectors.limit(0)).count() == 0


def test_neighbours_outside_dense_areas(spark):
    rng = np.random.default_rng(6)
    n, k = 6000, 20
    held = rng.standard_normal((20, 32))[rng.integers(0, 20, n)] + 0.25 * rng.standard_normal((n, 32))
    lone = np.arange(n) % 100 == 0
    held[lone] = rng.standard_normal((lone.sum(), 32))
    held /= np.linalg.norm(held, axis=1, keepdims=True)
    vectors = spark.createDataFrame(
        [(i, v) for i, v in enumerate(held.tolist())], "vec_id long, embedding array<double>")
    out = prefix_forest.nearest(vectors, vectors.filter("vec_id % 10 = 0"), k=k).collect()
    found = defaultdict(set)
    for r in out:
        found[r.query_id].add(r.vec_id)
    hits = {}
    for q in range(0, n, 10):
        scores = held @ held[q]
        scores[q] = -2
        hits[q] = len(found[q] & set(np.argsort(-scores)[:k].tolist())) / k
    assert {len(found[q]) for q in hits} == {k}
    assert np.mean([hits[q] for q in hits if lone[q]]) >= 0.85
    assert min(hits.values()) >= 0.5 and np.mean(list(hits.values())) >= 0.9


def test_few_vectors_are_all_found(spark):
    rng = np.random.default_rng(1)
    vectors = spark.createDataFrame(
        [(i, v) for i, v in enumerate(rng.standard_normal((12, 8)).tolist())],
        "vec_id long, embedding array<double>")
    out = prefix_forest.nearest(vectors, vectors, k=20).groupBy("query_id").count().collect()
    assert [r["count"] for r in out] == [11] * 12


# ---- 9 quality -----------------------------------------------------------------------------


def test_quality_held_out_accuracy(spark, sf):
    out = queries.QUERIES["op9_quality_classifier"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = out.filter("held_out").join(labels, "doc_id")
    assert held.filter("predicted = quality").count() / held.count() > 0.9
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_quality_edges(docs):
    stats = rule_quality.statistics(docs(["", None, "word " * 50_000, "###", "A b."]))
    row = stats.select(*[F.sum((F.isnan(c) | F.col(c).isNull()).cast("int")) for c in rule_quality.STATISTICS]).first()
    assert set(row) == {0}
    model = rule_quality.train(stats.withColumn("label", F.lit(1)))
    assert not model.weights and 0.5 < rule_quality.score(stats, model).first().score < 1
    assert rule_quality.train(stats.withColumn("label", F.lit(1)).limit(0)).intercept == 0.0


def test_rules_are_the_paths_of_a_tree():
    printed = ("Tree\n  If (feature 0 <= 1.5)\n   If (feature 1 > 2.0)\n    Predict: 0.0\n"
               "   Else (feature 1 <= 2.0)\n    Predict: 1.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0\n")
    rules = rule_quality.tree_rules(printed, ("x", "y"))
    assert {tuple((c.name, c.above, c.threshold) for c in r) for r in rules} == {
        (("x", False, 1.5),), (("x", True, 1.5),), (("x", False, 1.5), ("y", True, 2.0)),
        (("x", False, 1.5), ("y", False, 2.0))}


# ---- 10 packing ----------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_and_little_room(seed):
    rng = random.Random(seed)
    counts = Counter(min(64, 1 + int(rng.lognormvariate(2.5, 0.8))) for _ in range(3000))
    groups = packing.plan_sequences(dict(counts), 64)
    used = Counter()
    for lengths, times in groups:
        assert sum(lengths) <= 64 and times > 0
        used.update({n: c * times for n, c in Counter(lengths).items()})
    assert used == counts
    assert sum(t for _, t in groups) <= -(-sum(n * c for n, c in counts.items()) // 64) * 1.01 + 2


def test_packing(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(2)
    texts = [prose(rng, rng.choice([0, 1, 5, 30, 200])) for _ in range(60)] + [
        None, "", "<|endoftext|> é", "x <|endoftext|> y<|endoftext|><|endof"]
    pieces = packing.tokenised_pieces(docs(texts), queries.BYTE_BPE, capacity=64).persist()
    packed = packing.pack(pieces, capacity=64, salts=3)
    rows = sorted(packed.collect(), key=lambda r: (r.doc_id, r.piece))
    ids = defaultdict(list)
    for r in rows:
        assert r.start == len(ids[r.doc_id]) and r.length == len(r.ids) // 4
        ids[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == 64 or r.piece == 0
    assert {i: v for i, v in ids.items()} == {
        i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    whole = {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(packed).collect()}
    assert whole == {s: sum(n for _, n in held) for s, held in places.items()}
    assert packing.pack(pieces.limit(0), capacity=64).count() == 0


# ---- pipeline ------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    odd = spark.createDataFrame([(10 ** 9, None, "en", "s", 0), (10 ** 9 + 1, "12 34", None, None, None)],
                                docs.schema)
    docs = docs.union(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = corpus_pipeline.materialize(stage(spark, docs, sf))
        assert docs.columns == columns and docs.count() <= before, name
    left = docs.collect()
    assert len({r.doc_id for r in left}) == len(left) and not {r.doc_id for r in left} & {10 ** 9, 10 ** 9 + 1}
    assert all(set(r.text.split("\n")) <= set(texts[r.doc_id].split("\n")) for r in left)
    expected = brute_components({r.doc_id: r.text for r in left}, 5, 80, 100)
    assert all(c == i for i, (_, c) in expected.items())
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in left}
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf).count() == 0, name
