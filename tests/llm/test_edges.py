"""Nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from larder.llm import (
    curve_pack,
    html_template,
    language_id,
    quality_forest,
    shard_shuffle,
    simhash_links,
    token_store,
    topk_search,
    warc_fixity,
    weight_mix,
)
from larder.llm.tokens import TextEncoder
from larder.sources.workspace import fresh_folder


def test_simhash(odd_documents, no_documents):
    got = simhash_links.near_duplicates(odd_documents).collect()
    assert len(got) == odd_documents.count()
    zero = [r for r in got if r["fingerprint"] == "0" * 16]
    assert len(zero) == 3 and {r["component_id"] for r in zero} == {2}
    assert {r["component_id"] for r in got if r["doc_id"] in (0, 1)} == {0}
    assert simhash_links.near_duplicates(no_documents).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    star = [(100, i) for i in range(101, 400)] + [(399, 400), (7, 7)]
    edges = spark.createDataFrame(chain + star, "u long, v long")
    got = {r["node"]: r["root"] for r in simhash_links.components(edges).collect()}
    expected = {i: 1 for i in range(2, 41)} | {i: 100 for i in range(101, 401)}
    assert {n: r for n, r in got.items() if n != r} == expected


def test_long_lists_are_linked_like_short_ones():
    rng = np.random.default_rng(1)
    mask, free = simhash_links.positional_masks(2)[3]
    values = np.zeros(700, np.uint64)
    for bit in free:
        values |= rng.integers(0, 2, 700).astype(np.uint64) << np.uint64(bit)
    values = np.unique(values)

    def groups(pairs):
        label = {int(v): int(v) for v in values}
        for _ in range(len(values)):
            before = dict(label)
            for a, b in pairs.tolist():
                label[a] = label[b] = min(label[a], label[b])
            if label == before:
                return label

    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    every = np.array([(values[i], values[j]) for i, j in np.argwhere(close) if i < j], np.uint64)
    assert groups(simhash_links.spanning_links(values, free, 2)) == groups(every)


def test_quality(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(0, 1), (7, 0), (None, 1), (1, None), (0, 1)], "doc_id long, quality int")
    got = quality_forest.assess(odd_documents, labels, fit_rows=100).collect()
    assert len(got) == odd_documents.count()
    assert all(r["base_failed"] and not r["kept"] for r in got if not r["n_words"])
    bare = quality_forest.assess(odd_documents, labels.where("1 = 0"))
    assert len(bare.collect()) == len(got)
    assert quality_forest.assess(no_documents, labels).collect() == []


def test_isolated_rows_score_higher():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(500, 3))
    forest = quality_forest.IsolationForest.fit(rows)
    scores = forest.score(np.array([[0.0, 0, 0], [9.0, 9, 9]]))
    assert scores[0] < 0.5 < scores[1]
    # A constant table has nothing to cut: every row is an average one.
    assert quality_forest.IsolationForest.fit(np.ones((50, 2))).score(np.ones((1, 2)))[0] == pytest.approx(0.5)


def test_shards(odd_documents, no_documents):
    made = shard_shuffle.shuffled(odd_documents, 3)
    assert Counter(made.columns)["shard"] == 1 and "Shard" not in made.columns and "a.b" in made.columns
    got = made.collect()
    sizes = sorted(Counter(r["shard"] for r in got).values())
    assert sum(sizes) == odd_documents.count() and sizes[-1] - sizes[0] <= 1
    assert Counter(map(str, (r["doc_id"] for r in got))) == Counter(
        map(str, (r["doc_id"] for r in odd_documents.collect()))
    )
    assert shard_shuffle.shuffled(no_documents, 3).collect() == []


def test_matrix_has_its_sums_and_law():
    held, sizes = np.array([5, 0, 7, 4]), np.array([8, 8])
    counts = Counter()
    for seed in range(2000):
        matrix = shard_shuffle.communication_matrix(held, sizes, seed)
        assert (matrix.sum(1) == held).all() and (matrix.sum(0) == sizes).all()
        counts[int(matrix[0, 0])] += 1
    for k in range(6):
        law = math.comb(8, k) * math.comb(8, 5 - k) / math.comb(16, 5)
        assert abs(counts[k] / 2000 - law) < 0.04


def test_large_draws_lie_near_their_mean():
    rng = np.random.default_rng(3)
    draws = [shard_shuffle.drawn(rng, 10**10, 3 * 10**10, 1000) for _ in range(200)]
    assert abs(np.mean(draws) - 250) < 5 and 8 < np.std(draws) < 20


def test_store_round_trip(spark, odd_documents, no_documents, words_file):
    folder = fresh_folder(spark, "store")
    token_store.write_store(odd_documents, folder, words_file)
    got = token_store.read_digests(spark, folder).collect()
    assert len(got) == odd_documents.count()
    starts = sorted((r["start"], r["n_tokens"]) for r in got)
    assert [s for s, _ in starts] == [0, *np.cumsum([n for _, n in starts])[:-1].tolist()]
    coder = Tokenizer.from_file(words_file)
    texts = [r["text"] for r in odd_documents.where("doc_id = 3").collect()]
    expected = [[*coder.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    assert sorted(token_store.read_document(spark, folder, 3)) == sorted(expected)
    assert token_store.read_document(spark, folder, 99) == []
    empty = fresh_folder(spark, "store")
    token_store.write_store(no_documents, empty, words_file)
    assert token_store.read_digests(spark, empty).collect() == []


def test_store_refuses_another_dictionary(spark, odd_documents, words_file):
    one, two = fresh_folder(spark, "store"), fresh_folder(spark, "store")
    token_store.write_store(odd_documents, one, words_file)
    blocks = spark.read.schema(token_store.BLOCKS).parquet(f"{one}/blocks")
    blocks.withColumn("dictionary", F.lit("other")).write.parquet(f"{two}/blocks")
    spark.read.parquet(f"{one}/dictionary").write.parquet(f"{two}/dictionary")
    with pytest.raises(ValueError, match="dictionary"):
        token_store.read_document(spark, two, 0)


def test_blocks_are_cut(spark, words_file, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_BYTES", 64)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.format_string("w%d %d", "id", "id").alias("text"))
    folder = fresh_folder(spark, "store")
    token_store.write_store(docs.repartition(3), folder, words_file)
    got = token_store.read_digests(spark, folder).orderBy("doc_id").collect()
    sums = np.cumsum([r["n_tokens"] for r in got]).tolist()
    assert [r["start"] for r in got] == [0, *sums[:-1]]


def test_packing(odd_documents, no_documents, bytes_file):
    got = curve_pack.packed(odd_documents, bytes_file, length=16).collect()
    coder = Tokenizer.from_file(bytes_file)
    total = sum(len(coder.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in odd_documents.collect())
    assert sum(r["length"] for r in got) == total
    assert all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in got)
    places = sorted(r["sequence_id"] * 16 + r["offset"] for r in got)
    assert places[0] == 0 and len(set(places)) == len(places)
    assert curve_pack.packed(no_documents, bytes_file).collect() == []


def test_hilbert_curve_steps_to_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = curve_pack.hilbert_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Ä.é,'\n\t  ́ß1<|endoftx|>"), max_size=40), max_size=6))
def test_encoding_by_pieces_equals_whole_texts(texts):
    for name, joins in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        import public_tokenizers

        path = public_tokenizers.path(name)
        coder = CODERS.setdefault(name, TextEncoder(path, joins, cached=20))
        ids, counts = coder.encode([*texts, None])
        expected = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [*map(len, expected), 0]
        assert ids.tolist() == [i for one in expected for i in one]


CODERS = {}


def test_language(odd_documents, no_documents):
    got = language_id.identify(odd_documents, F.lit(True)).collect()
    assert len(got) == odd_documents.count()
    assert sum(r["lang_pred"] == "und" and r["score"] == 0 for r in got) == 3
    untaught = language_id.identify(odd_documents, F.lit(False)).collect()
    assert {(r["lang_pred"], r["score"]) for r in untaught} == {("und", 0.0)}
    assert language_id.identify(no_documents, F.lit(True)).collect() == []


def test_runs_of_letters():
    grams, starts, letters = language_id.runs(["ab", "", None, "1"])
    a, b, up, upper = 1, 2, 6, 12
    assert grams.tolist() == [a << up | b, a << upper | b << up, b << upper]
    assert letters.tolist() == [2, 0, 0, 0] and starts.tolist() == [0, 3, 3, 3]


VECTORS = [
    (0, [0.5, 0.25]),
    (50, [0.5, 0.25]),
    (100, [float("nan"), 1.0]),
    (150, None),
    (200, [None, 1.0]),
    (250, [1.0, 2.0, 3.0]),
    (300, []),
    (None, [1.0, 1.0]),
    (7, [-0.3, 0.9]),
    (8, [0.5, 0.25]),
    (9, [0.5, 0.25]),
    (9, [0.5, 0.25]),
    (10, [float("inf"), 0.0]),
    (11, [4.0, 5.0, 6.0]),
]


def test_top_k(spark):
    table = spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk_search.top_k(table, k=3).collect()}
    same = 128 * 128 + 64 * 64
    assert [got[0, i] for i in (1, 2, 3)] == [(8, same), (9, same), (9, same)]
    assert [got[50, i] for i in (1, 2, 3)] == [(0, same), (8, same), (9, same)]
    assert got[250, 1][0] == 11 and (250, 2) not in got and (300, 1) not in got
    assert {q for q, _ in got} == {0, 50, 250}
    assert topk_search.top_k(table.where("1 = 0")).collect() == []


def test_dual_trees_are_exact_and_prune():
    rng = np.random.default_rng(4)
    middles = rng.integers(-200, 200, (12, 8))
    rows = (middles[rng.integers(0, 12, 3000)] + rng.integers(-3, 4, (3000, 8))).astype(np.int64)
    queries, own = rows[:40], np.arange(40)
    best = topk_search.dual_search(queries, own, np.full(40, topk_search.NOTHING), rows, np.arange(3000), 5)
    assert best.visited < 0.5 * 40 * 3000
    for i in range(40):
        scores = rows @ rows[i]
        scores[i] = topk_search.NOTHING
        order = np.lexsort((np.arange(3000), -scores))[:5]
        assert best.ids[i].tolist() == order.tolist() and best.scores[i].tolist() == scores[order].tolist()


def test_cells_that_cannot_reach_are_left_out():
    rng = np.random.default_rng(5)
    middles = rng.integers(-200, 200, (40, 8))
    rows = (middles[rng.integers(0, 40, 4000)] + rng.integers(-3, 4, (4000, 8))).astype(np.float64)
    net, _ = topk_search.farthest_first(rows[:1000], 64)
    net = rows[net]
    gaps = np.linalg.norm(rows[:, None] - net[None], axis=2)
    cell, radii = gaps.argmin(1), np.full(len(net), -1.0)
    np.maximum.at(radii, cell, gaps.min(1))
    queries = rows[:50]
    scores = queries @ rows.T
    floors = np.sort(scores, axis=1)[:, -6]
    left = topk_search.cells_left(queries, floors, net, radii)
    for i in range(50):
        assert left[i][cell[scores[i] >= floors[i]]].all()
    assert left.mean() < 0.3
    assert (topk_search.parents_of(net)[: topk_search.COARSE] == np.arange(topk_search.COARSE)).all()


def test_clustered_vectors_are_found_whatever_the_net(spark, monkeypatch):
    rng = np.random.default_rng(6)
    middles = rng.normal(size=(30, 6))
    rows = middles[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 6)) / 20
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(rows)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(topk_search, "BLOCK", 64)
    ints = np.floor(rows * 256).astype(np.int64)
    for pivots in (None, 1, 200):
        got = {}
        for r in topk_search.top_k(df, k=4, every=100, pivots=pivots).collect():
            got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
        assert sorted(got) == list(range(0, 3000, 100))
        for q, found in got.items():
            scores = ints @ ints[q]
            scores[q] = topk_search.NOTHING
            order = np.lexsort((np.arange(3000), -scores))[:4]
            assert found == {n + 1: (int(i), int(scores[i])) for n, i in enumerate(order)}


PAGES = [
    (1, "http://h.example/a", "<body><nav>Menu</nav><article><header><h1>T &amp; U</h1></header><p>one\n two<p>three</article>"),
    (2, "http://H.example/b", "<p>no article <b>bold</b><script>if (a < b) {}</script><p>second"),
    (3, None, "<div class='comments'>Nice!</div><div id=x>Text &lt;here&gt;"),
    (4, "http://h.example/c", None),
    (5, "http://h.example/d", ""),
    (5, "http://h.example/d", ""),
    (None, "mailto:x", "plain < text & more <!-- gone --> <unclosed"),
    (6, "x", "<main><p>In<aside>Side</aside><form>Form</form><p>Out<div class='cookie-notice'>C</div></main><footer>F"),
]


def test_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("Text", F.lit(1))
    got = {r["page_id"]: r["text"] for r in html_template.main_text(pages).collect()}
    assert got == {
        1: "T & U\none two\nthree",
        2: "no article bold\nsecond",
        3: "Text <here>",
        4: "",
        5: "",
        None: "plain < text & more",
        6: "In\nOut",
    }
    assert html_template.main_text(pages).count() == len(PAGES)
    joined = html_template.main_text(pages, broadcast_bytes=0).collect()
    assert {r["page_id"]: r["text"] for r in joined} == got
    assert html_template.main_text(pages.where("1 = 0")).collect() == []


def test_template_without_article_tags(spark):
    rows = []
    for i in range(8):
        body = "".join(f"<p>Sentence {i} {j} of the page with its own words.</p>" for j in range(4))
        rows.append((i, "http://one.example/", f"<body><div class=top>Welcome to us</div><div class=c1>{body}</div><div>All rights reserved</div>"))
    got = html_template.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in got:
        i = r["page_id"]
        assert r["text"] == "\n".join(f"Sentence {i} {j} of the page with its own words." for j in range(4))


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<div class='wrap has-sidebar'><article>Text</article><div class=sidebar>Side</div></div>", "Text"),
        ("<div class='layout no-sidebar'><p>Text</p></div><nav>Go</nav>", "Text"),
        ("<div class='post comments-open'><p>Text</p><div class='post-comments'>Well</div></div>", "Text"),
        ("<div class='page social-share-enabled'><article>Text</article></div>", "Text"),
        ("<div class='sidebar-right'><article><p>Text</p><div class=share>Tell</div></article></div>", "Text"),
        ("<body><form><nav>Go</nav><p>All of the text</p></form></body>", "All of the text"),
        ("<form><article>Text</article></form><p>Some longer text around it all.</p>", "Text"),
        ("<div title='the hidden truth'><article>Text</article></div>", "Text"),
        ("<div hidden><article>Gone</article></div><div hidden=''>Gone</div><p>Text</p>", "Text"),
        ("<article>Text</article><div class=comments><article>A much longer comment on it.</article></div>", "Text"),
        ("<article>Text</article><aside><article>Other</article></aside>", "Text"),
    ],
)
def test_names_around_the_article(source, text):
    assert html_template.extract(html_template.parse(source), set(), None) == text


def test_template_region_inside_a_named_one():
    page = html_template.parse("<div class=widget><div class=c><p>Text</p></div></div><p>Longer words beside.</p>")
    assert html_template.extract(page, set(), "/div.widget/div.c") == "Text"


def main_texts(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in html_template.main_text(pages).collect()}


def words(i, j=0):
    return f"Sentence {i} {j} of the page with its own words."


def test_template_inside_marked_articles(spark):
    notice = "<div class=n>Read us daily</div>"
    rows = [
        (i, "http://one.example/", f"<body><article><h1>Title {i}</h1>{notice if i % 4 else ''}<p>{words(i)}</p></article>")
        for i in range(8)
    ]
    assert main_texts(spark, rows) == {i: f"Title {i}\n{words(i)}" for i in range(8)}


def test_copies_of_an_article_are_no_template(spark):
    rows = [(i, "http://one.example/", f"<body><i>{i}</i><article><p>{words(1)}</p><p>And so on</p></article>") for i in range(8)]
    assert main_texts(spark, rows) == {i: f"{words(1)}\nAnd so on" for i in range(8)}


def test_a_layout_of_few_pages_has_its_template(spark):
    rows = [(i, "http://one.example/", f"<body><div class=a><p>{words(i)}</p></div>") for i in range(20)]
    rows += [
        (i, "http://one.example/", f"<body><div class=b><p>Only in some</p><p>{words(i)}</p></div>") for i in range(20, 24)
    ]
    assert main_texts(spark, rows) == {i: words(i) for i in range(24)}


def test_marks_with_little_text_are_no_article(spark):
    rows = [
        (i, "http://one.example/", f"<body><article>Card {i}</article><div class=c><p>{words(i)}</p><p>{words(i, 1)}</p></div>")
        for i in range(6)
    ]
    assert main_texts(spark, rows) == {i: f"{words(i)}\n{words(i, 1)}" for i in range(6)}


def test_classes_have_one_order_and_slot():
    page = html_template.parse("<body><h1>T</h1><p>A</p><p>B</p></body>")
    other = html_template.parse("<body><h1>T</h1><p>B</p><p>A</p></body>")
    a, b = (n.number for n in page.blocks[1:])
    body, head = (html_template.path_number(t) for t in ("/body", "/body/h1"))
    known = {body: (1, 2), head: (1, 3), a: (7, 8), b: (7, 8)}
    sizes = {1: 2, 2: 1, 3: 1, 7: 2, 8: 2, body: 1, head: 1, a: 1, b: 1}
    one, two = html_template.units(page, known, sizes), html_template.units(other, known, sizes)
    assert min(one.values()) >= 0 and min(two.values()) >= 0
    assert {u for u in one if one[u] != two[u]} == {7, 8}  # another order
    moved = html_template.units(html_template.parse("<body><p>A</p><h1>T</h1><p>B</p></body>"), known, sizes)
    assert moved[7] == -1 and moved[a] != one[a] and moved[b] == one[b]  # another slot


def test_a_text_without_a_fixed_slot_is_no_template(spark):
    rows = []
    for i in range(8):
        texts = [f"<p>{words(i)}</p>", "<h2>Part</h2>", f"<p>{words(i, 1)}</p>"]
        texts.insert(3 * (i % 2), "<blockquote>So it goes</blockquote>")
        rows.append((i, "http://one.example/", f"<body><article>{''.join(texts)}</article>"))
    rows.append((8, "http://one.example/", f"<body><article><p>{words(8)}</p><h2>Part</h2></article>"))
    got = main_texts(spark, rows)
    # The heading is the template's, and stays where it heads what is the article's own.
    assert all("So it goes" in got[i] and "Part" in got[i] for i in range(8)) and "Part" not in got[8]


def test_fixity(spark):
    pages = spark.createDataFrame(
        [(i, f"u{i}", "x" * i) for i in range(40)] + [(None, None, None), (3, "u3", "xxx"), (3, "u3", "xxx")],
        "page_id long, url string, html string",
    )
    leaves = warc_fixity.leaves(warc_fixity.records(pages), per_archive=16)
    bad = F.col("key").isin(20, 21)
    worn = leaves.where("key is null or key <> 30").withColumn(
        "digest", F.when(bad, F.reverse("digest")).otherwise(F.col("digest"))
    )
    found = warc_fixity.audit(leaves, worn, per_archive=16, fan=4).collect()
    assert Counter(r["state"] for r in found) == {"ok": 40, "damaged": 2, "lost": 1}
    moved = leaves.withColumn("offset", F.col("offset") + 1)
    assert {r["state"] for r in warc_fixity.audit(leaves, moved, 16, 4).collect()} == {"moved"}
    back = warc_fixity.audit(worn, leaves, per_archive=16, fan=4).collect()
    assert Counter(r["state"] for r in back)["added"] == 1
    nothing = leaves.where("1 = 0")
    assert warc_fixity.audit(nothing, nothing, 16, 4).collect() == []


def test_differing_branches_only(spark):
    leaves = warc_fixity.leaves(warc_fixity.records(spark.createDataFrame(
        [(i, f"u{i}", "x") for i in range(256)], "page_id long, url string, html string")), per_archive=64)
    worn = leaves.withColumn("digest", F.when(F.col("key") == 200, "0").otherwise(F.col("digest")))
    one, two = warc_fixity.tree(leaves, 64, 4), warc_fixity.tree(worn, 64, 4)
    assert one[-1].count() == 4
    assert [tuple(r) for r in warc_fixity.differing(one, two, 4).collect()] == [(3, 8)]


def test_warc_files_have_the_leaves(spark):
    pages = spark.createDataFrame(
        [(i, f"http://x/{i}", f"<p>é {i}\r\n\r\nWARC</p>") for i in range(30)], "page_id long, url string, html string"
    )
    folder = fresh_folder(spark, "warc")
    warc_fixity.write_warc(pages, folder, per_archive=8)
    read = warc_fixity.read_warc(spark, folder).select(warc_fixity.LEAF.names).collect()
    made = warc_fixity.leaves(warc_fixity.records(pages), per_archive=8).select(warc_fixity.LEAF.names).collect()
    assert sorted(map(tuple, read)) == sorted(map(tuple, made))


def test_audit_of_damaged_files(spark, tmp_path):
    pages = spark.createDataFrame(
        [(i, f"http://x/{i}", f"<p>{i}</p>" * (i + 1)) for i in range(30)], "page_id long, url string, html string"
    )
    one = fresh_folder(spark, "warc")
    warc_fixity.write_warc(pages, one, per_archive=8, compression="gzip")
    first = warc_fixity.read_warc(spark, one)
    for name, change, expected in [
        ("dropped", lambda key, record: None if key == 10 else record, {10: "lost"} | dict.fromkeys(range(11, 16), "moved")),
        ("zeros", lambda key, record: bytes(len(record)) if key == 10 else record, {10: "lost"}),
        ("header", lambda key, record: b"X" + record[1:] if key == 10 else record, {10: "damaged"}),
        (
            "length",
            lambda key, record: record.replace(b"Content-Length: ", b"Content-Length: 9") if key == 10 else record,
            {10: "damaged"} | dict.fromkeys(range(11, 16), "moved"),
        ),
        ("id", lambda key, record: record.replace(b"urn:record", b"urn:recorx") if key == 10 else record, {10: "damaged"}),
    ]:
        two = str(tmp_path / name)
        warc_fixity.copy_warc(spark, one, two, change)
        found = warc_fixity.audit(first, warc_fixity.read_warc(spark, two), per_archive=8, fan=2).collect()
        assert sorted((r["key"], r["state"]) for r in found) == [(i, expected.get(i, "ok")) for i in range(30)]


def plain_schedule(weights, slots):
    """Earliest deadline first, one slot after the other, in whole numbers."""
    total, had, out = sum(weights.values()), dict.fromkeys(weights, 0), []
    for slot in range(slots):
        released = [s for s in sorted(weights) if had[s] * total // weights[s] <= slot]
        chosen = min(released, key=lambda s: (-(-(had[s] + 1) * total // weights[s]), s))
        out.append((chosen, had[chosen]))
        had[chosen] += 1
    return out


@pytest.mark.parametrize(
    "weights",
    [
        {"a": 5, "b": 3, "c": 1},
        {"hot": 24170} | {f"s{i}": 3990 + i % 3 for i in range(19)},
        {"most": 1 << 29, "some": 1 << 20, "few": 1},
        {"alone": 7},
    ],
)
def test_schedule_is_earliest_deadline_first(spark, monkeypatch, weights):
    """Against the plain schedule, and within a block of the exact share at every slot."""
    monkeypatch.setattr(weight_mix, "RUN", 64)
    monkeypatch.setattr(weight_mix, "RUNS", 8)
    table = spark.createDataFrame(list(weights.items()), "name string, weight long")
    slots = 1500
    got = weight_mix.schedule(table, slots).orderBy("mix_slot").collect()
    assert [r["mix_slot"] for r in got] == list(range(slots))
    assert [(r["name"], r["mix_block"]) for r in got] == plain_schedule(weights, slots)
    had, total = Counter(), sum(weights.values())
    for t, row in enumerate(got, 1):
        had[row["name"]] += 1
        assert all(abs(had[s] * total - t * w) < total for s, w in weights.items())


def test_mix_of_very_many_sources(spark):
    docs = spark.range(2600).select("id", F.concat(F.lit("host"), F.col("id") % 1300).alias("source"))
    weights = weight_mix.tempered_weights(docs, "source", 0.5)
    got = weight_mix.mixed(docs, weights, block=1).collect()
    assert sorted(r["id"] for r in got if r["mix_epoch"] == 0) == list(range(2600))
    assert len({r["mix_source"] for r in got[:]}) == 1300


def test_blocks_grow_with_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(weight_mix, "MOST_SLOTS", 50)
    docs = spark.range(1000).select("id", F.lit("a").alias("source"))
    got = weight_mix.mixed(docs, {"a": 1.0}, block=2)
    assert got.agg(F.max("mix_slot")).first()[0] + 1 == 50 and got.count() == 1000


def test_mix(odd_documents, no_documents):
    made = weight_mix.mixed(odd_documents, {"a": 2.0, "b": 1.0, "gone": 4.0}, block=1)
    got = made.collect()
    assert Counter(str(r["doc_id"]) for r in got if r["mix_epoch"] == 0) == Counter(
        str(r["doc_id"]) for r in odd_documents.collect()
    )
    assert {r["mix_source"] for r in got} == {"a", "b", "(rest)"}
    assert len({(r["mix_slot"], r["mix_place"]) for r in got}) == len(got)
    once = weight_mix.mixed(odd_documents, {"a": 2.0}, block=2, repeat=False)
    assert once.count() == odd_documents.count()
    assert weight_mix.mixed(no_documents, {"a": 1.0}).collect() == []
    assert weight_mix.mixed(odd_documents, {}).where("mix_epoch = 0").count() == odd_documents.count()


def test_shares_hold_to_the_end(spark):
    docs = spark.range(3000).select("id", F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"))
    got = weight_mix.mixed(docs, {"a": 1.0, "b": 1.0}, block=10).groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in got} == {"a": 2000, "b": 2000}


def test_mix_has_no_python(spark, plan):
    docs = spark.range(10).select("id", F.lit("a").alias("source"))
    text = plan(weight_mix.mixed(docs, {"a": 1.0}))
    assert not any(word in text for word in ("Python", "Pandas", "Arrow"))


def test_pipeline_stages_on_odd_rows(spark, odd_documents, no_documents, tmp_path):
    shaped = odd_documents.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
    for docs in (shaped, shaped.where("1 = 0")):
        folder = str(tmp_path / f"t{docs.count()}")
        spark.createDataFrame([(0, 1)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, folder).columns == corpus_pipeline.COLUMNS
        groups = corpus_pipeline.near_duplicates(spark, docs, folder).count()
        assert groups == simhash_links.near_duplicates(docs).select("component_id").distinct().count()
