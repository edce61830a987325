"""Operators on whole corpora against brute force."""

import os
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from nomograph.llm import components, cover_tree, html_extract, langid, minhash, mixing, pii, rules, secrets, weak_quality
from nomograph.llm import bpe as bpe_ops
from nomograph.llm.registry import QUERIES
from tests.conftest import DATA
from tests.llm.helpers import EXTRA, SCHEMA, awkward, components as brute_components, documents, prose, shingle_set, words


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)] + [(2000, 2000 + i) for i in range(50)]
    got = {x.id: x.component_id for x in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = {i for e in edges if e[0] != e[1] for i in e}
    assert got == brute_components(ids, [e for e in edges if e[0] != e[1]])
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


# --- near-duplicate documents ---


def brute_near(docs):
    sets = {i: shingle_set(t) for i, t in docs}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    part = brute_components(ids, links)
    return {i: (len(sets[i]), part[i], part[i] == i) for i in ids}


def edited(text, r, n):
    w = text.split(" ")
    for _ in range(n):
        k = r.randrange(len(w))
        w[k : k + 1] = r.choice([[], [w[k], "new%d" % r.randrange(999)], ["sub%d" % r.randrange(999)]])
    return " ".join(w)


@pytest.fixture(scope="module")
def copies():
    """Exact, near and chained copies, short and boilerplate texts, and one large group of near copies."""
    r, docs = random.Random(9), [(i, t) for i, t, *_ in awkward() if i is not None and i != 11]
    base = prose(100, 150)
    for i in range(60):
        docs.append((100 + i, edited(base, r, r.randint(0, 5))))
    chain = prose(200, 120)
    for i in range(25):
        chain = edited(chain, r, 2)
        docs.append((200 + i, chain))
    for i in range(60):
        docs.append((300 + i, prose(i, r.randint(1, 9)) + " licensed under the same public licence version two"))
    for i in range(40):
        docs.append((400 + i, prose(1000 + i // 2, r.choice([3, 5, 6, 8, 40, 300]) if i % 2 else 40)))
    docs += [(500, "A b C d E f"), (501, "a B c D e F"), (502, "a b c"), (503, "A B C"), (504, "a b c d e a b c d e"), (505, "a b c d e a b c d e a b c d e")]
    return docs


def test_near_duplicates(spark, copies):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(documents(spark, copies)).collect()}
    assert got == brute_near(copies)


def test_remaining_comparisons_find_every_link(spark, copies, monkeypatch):
    """With blocks of a few documents and no links to start from, the block comparisons alone give the components."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "FEW", 1)
    monkeypatch.setattr(minhash, "confirmed", lambda docs, registers, pairs: pairs.limit(0))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(documents(spark, copies)).collect()}
    assert got == brute_near(copies)


def test_query_equals_brute_force(spark):
    rows = QUERIES["op6_minhash"](spark, DATA).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == brute_near(docs)


def test_estimate_is_close(spark):
    r = random.Random(1)
    for share in (0.5, 0.75, 0.9):
        errors = []
        for _ in range(60):
            h = np.unique(np.array([r.getrandbits(64) for _ in range(800)], np.uint64))
            n = int(len(h) * 2 * share / (1 + share))
            other = np.unique(np.concatenate([h[:0], np.random.default_rng(r.getrandbits(30)).choice(h, n, replace=False), np.array([r.getrandbits(64) for _ in range(len(h) - n)], np.uint64)]))
            x, y = minhash.sketch(h)[0], minhash.sketch(other)[0]
            true = len(np.intersect1d(h, other)) / len(np.union1d(h, other))
            errors.append(((x == y).mean() - minhash.CHANCE) / (1 - minhash.CHANCE) - true)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_keep_one_of_each(spark, copies):
    docs = documents(spark, copies, extra=True)
    kept = minhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, _, k) in brute_near(copies).items() if k}


def test_keep_one_of_each_by_row(spark):
    """Repeated rows, rows without ids, ids that name several texts: one row of each group stays."""
    a, b, c, d = (prose(k, 60) for k in range(50, 54))
    rows = [(1, a), (1, a), (2, a.replace("alpha", "other", 1)), (None, a), (None, b), (None, b), (5, c), (5, d), (6, c), (7, ""), (7, ""), (8, None)]
    kept = minhash.keep_one_of_each(documents(spark, rows, extra=True))
    assert kept.columns == documents(spark, rows, extra=True).columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, a), (None, b), (5, d), (6, c), (7, ""), (8, None)], key=str)


def test_one_digest_on_half_of_all_rows(spark):
    same, other = prose(60, 40), [(i, prose(i, 30)) for i in range(2000, 2400)]
    rows = [(i, same) for i in range(400)] + other
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == {i: 0 if i < 400 else i for i, _ in rows}


def test_pairs_at_the_threshold_are_all_found(spark):
    """Pairs whose similarity is exactly 0.75: 6 n shingles in common, n of its own for each."""
    rows = []
    for k in range(300):
        n = 1 + k % 60
        shared = " ".join(f"s{k}x{i}" for i in range(6 * n + 4))
        rows += [(2 * k, shared + "".join(f" a{k}x{i}" for i in range(n))), (2 * k + 1, shared + "".join(f" b{k}x{i}" for i in range(n)))]
    assert 100 * len(shingle_set(rows[0][1]) & shingle_set(rows[1][1])) == 75 * len(shingle_set(rows[0][1]) | shingle_set(rows[1][1]))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_one_labelled_id_on_very_many_rows(spark):
    """The sample for toxicity counts a repeated row once, before anything reaches the driver."""
    docs = [(i, f"you {'rotten trash' if i % 2 else 'kind person'} number {i}", "en") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    one = weak_quality.learn_toxicity(documents(spark, docs), labels)
    many = documents(spark, docs).unionByName(documents(spark, docs[:1]).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(100_000)))).drop("n"))
    again = weak_quality.learn_toxicity(many, labels)
    assert one.weights and one.weights == again.weights and one.scorers == again.scorers


@pytest.mark.parametrize("labels", [[], [(None, 1, 1), (3, None, None)], [(3, 1, 1), (3, 1, 0), (4, 1, 0)], [(99, 1, 1)]])
def test_toxicity_of_awkward_tables(spark, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for rows in (awkward(), []):
        docs = documents(spark, rows, extra=True)
        got = weak_quality.score(docs, weak_quality.learn(docs)[1], weak_quality.learn_toxicity(docs, known))
        assert got.count() == len(rows)


# --- near-duplicate embeddings ---


def brute_vectors(rows):
    good = {i: np.array(v, float) for i, v in rows if v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}
    ids = sorted(i for i, _ in rows)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if a in good and b in good and len(good[a]) == len(good[b]) and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.95]
    part, n = brute_components(ids, links), defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return {i: (n[i], part[i], part[i] == i) for i in ids}


@pytest.mark.parametrize("block, pivots, radii", [(4096, 512, None), (8, 4, None), (5, 64, (1.0, 0.5, 0.05, 0.01))])
def test_embeddings(spark, monkeypatch, block, pivots, radii):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    monkeypatch.setattr(cover_tree, "PIVOTS", pivots)
    monkeypatch.setattr(cover_tree, "OPEN", 50)
    if radii:
        monkeypatch.setattr(cover_tree, "RADII", radii)
    g, rows = np.random.default_rng(3), []
    centres = g.normal(size=(6, 12))
    for i in range(150):
        rows.append((i, (centres[i % 6] + g.normal(size=12) * g.choice([0.05, 0.2, 0.4])).astype(np.float32).tolist()))
    rows += [(200 + i, rows[0][1]) for i in range(12)] + [(220 + i, [x * (i + 2) for x in rows[7][1]]) for i in range(5)]
    rows += [(300, None), (301, []), (302, [0.0] * 12), (303, [None] + [1.0] * 11), (304, [float("nan")] * 12), (305, [float("inf")] + [0.0] * 11), (306, [1.0, 0.0]), (307, [2.0, 0.1]), (308, [1e-30] * 12), (309, [1e30] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "7 AS rep", "7 AS size", "7 AS digest", "7 AS label")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.near_duplicates(df).collect()}
    assert got == brute_vectors([(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows])


def test_embedding_tables(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in QUERIES["op2_cover_tree"](spark, DATA).collect()} == brute_vectors(rows)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cover_tree.near_duplicates(empty).count() == 0


def test_embeddings_without_or_with_shared_ids(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.99, 0.05, 0.0]
    rows = [(None, a), (1, a), (2, c), (None, b), (None, None), (7, a), (7, [0.0, 0.0, 1.0]), (8, None), (8, a)]
    got = sorted(map(tuple, cover_tree.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()), key=str)
    assert got == sorted([(None, 4, 1, None), (1, 4, 1, True), (2, 4, 1, False), (7, 4, 1, False), (8, 4, 1, False), (None, 0, None, None), (None, 0, None, None), (7, 0, 7, True), (8, 0, 8, True)], key=str)


def test_vectors_without_structure_open_few_nodes(monkeypatch):
    """Radii tell nothing here: the traversal gets the pairs of nodes with near vectors, not nearly all."""
    g = np.random.default_rng(5)
    x = g.normal(size=(3000, 64))
    x[::100] = x[1::100] + g.normal(size=(30, 64)) * 0.05
    tree = cover_tree.Tree(np.arange(3000), np.ones(3000, int), x, cover_tree.build(cover_tree._unit(x)))
    opened, visit = [], cover_tree.Traversal._visit
    monkeypatch.setattr(cover_tree.Traversal, "_visit", lambda self, level, i, j: (opened.append(len(i)) if level == 0 else None, visit(self, level, i, j))[1])
    linked = cover_tree.Traversal(tree, None).linked
    assert linked.sum() == 60 and sum(opened) == 30
    a, b = (cover_tree.Tree(np.arange(1500), np.ones(1500, int), y, cover_tree.build(cover_tree._unit(y))) for y in (x[::2], x[1::2]))
    opened.clear()
    assert cover_tree.Traversal(a, b).linked.sum() == 60 and sum(opened) == 30


@pytest.mark.parametrize("few, opened, many, tile", [(1e9, 0.05, 0.02, (7, 5)), (0, 0.0, 0.02, (7, 5)), (0, 0.0, 1, (64, 64)), (1e9, 0, 0, (3, 4))])
def test_embeddings_however_nodes_are_looked_at(spark, monkeypatch, few, opened, many, tile):
    for name, value in (("FEW", few), ("OPENED", opened), ("MANY", many), ("TILE", tile), ("BLOCK", 30), ("OPEN", 50)):
        monkeypatch.setattr(cover_tree, name, value)
    g = np.random.default_rng(9)
    rows = [(i, (np.eye(8)[i % 5] + g.normal(size=8) * g.choice([0.02, 0.1, 0.5])).tolist()) for i in range(140)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.near_duplicates(df).collect()} == brute_vectors(rows)


def test_a_block_of_vectors_travels_as_one_row():
    x = np.random.default_rng(1).normal(size=(50, 6)).astype(np.float32)
    block = pa.table({"rep": pa.array(range(50), pa.int64()), "rows": pa.array([2] * 50, pa.int64()), "size": pa.array([6] * 50, pa.int32()), "embedding": pa.array(x.tolist(), pa.list_(pa.float32())), "cell": pa.array([3] * 50, pa.int32()), "salt": pa.array([1] * 50, pa.int32())})
    packed = cover_tree._planted(block)
    assert packed.num_rows == 1 and packed["vectors"][0].as_py() == x.tobytes()
    tree = cover_tree._tree(packed, {})
    assert sorted(tree.ids.tolist()) == list(range(50)) and (tree.counts == 2).all() and np.allclose(tree.u, cover_tree._unit(x.astype(float))[tree.ids])


# --- mixing ---


def brute_targets(sizes):
    """By the contract's own iteration: share by weight, stop at the cap, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, full, target = 1.5 * sum(sizes.values()), set(), {}
    while len(full) < len(names):
        rest = [s for s in names if s not in full]
        total = sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in rest}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            full.add(s)
    return target


def test_mixing(spark):
    r, docs = random.Random(8), list(awkward())
    for i in range(300):
        docs.append((1000 + i, prose(i, r.randint(0, 60)), "en", r.choice(["big"] * 6 + ["a", "b", "é", "zz", None])))
    df = documents(spark, docs, extra=True)
    rows = mixing.words_taken(df).collect()
    assert sorted((str(x.doc_id), x.size) for x in rows) == sorted((str(d[0]), len(words(d[1]))) for d in docs)
    sizes = defaultdict(int)
    for d in docs:
        sizes[d[3]] += len(words(d[1]))
    wanted = brute_targets(sizes)
    taken, by_id = defaultdict(int), {d[0]: d[3] for d in docs}
    for x in rows:
        s = by_id[x.doc_id]
        taken[s] += x.taken
        assert abs(x.target - wanted[s]) < 1e-6 and x.source_size == sizes[s] and 0 <= x.taken <= 2 * x.size
    for s, t in taken.items():
        assert abs(t - wanted[s]) <= 3, (s, t, wanted[s])
    assert sorted(map(str, rows)) == sorted(map(str, mixing.words_taken(df.repartition(7)).collect()))


def test_mix_takes_whole_documents(spark):
    docs = [(i, prose(i, 20 + i % 7), "en", "ab"[i % 5 == 0]) for i in range(120)]
    df = documents(spark, docs, extra=True)
    out = mixing.mix(df)
    assert out.columns == df.columns
    got = defaultdict(int)
    for row in out.collect():
        assert row.text == docs[row.doc_id][1]
        got[row.source] += len(words(row.text))
    sizes = {s: sum(len(words(d[1])) for d in docs if d[3] == s) for s in "ab"}
    assert all(abs(got[s] - t) < 30 for s, t in brute_targets(sizes).items())


def test_mixing_with_many_ranges(spark, monkeypatch):
    df = documents(spark, [(i, prose(i, i % 11), "en", "abc"[i % 3]) for i in range(400)])
    one = sorted(map(tuple, mixing.words_taken(df).collect()))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 2)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(tuple, mixing.words_taken(df).collect())) == one
    monkeypatch.setattr(mixing, "DIGITS", 1)
    assert sorted(map(tuple, mixing.words_taken(df).collect())) == one


# --- pages ---


def page(body, article=True):
    inner = f"<article><h1>T</h1>{body}</article>" if article else body
    return f"<html><head><title>x</title><script>var a='<p>';</script></head><body><nav><a>menu</a></nav><div class='ad-slot'>buy</div>{inner}<footer>end</footer></body></html>"


def test_pages(spark):
    rows = [
        (1, "http://h/a/1", page("<p>one &amp; two<br>three</p><div id='comments'><p>first!</p></div><form><p>name</p></form>")),
        (2, "http://h/a/2", page("<div>Site line</div><p>own two</p><div>Bottom</div>", False)),
        (3, "http://h/a/3", page("<div>Site line</div><p>own three</p><div>Bottom</div>", False)),
        (4, "http://h/a/3", page("<div>Site line</div><p>own three</p><div>Bottom</div>", False)),
        (5, "http://lonely/x", page("<p>kept <i>alone</i></p>", False)),
        (6, None, None),
        (7, "http://h/b", ""),
        (8, "not a url", "<p>a<p>b<nav><p>menu</article>"),
        (9, "http://h/c", page("<p>" + "long " * 50_000 + "</p>")),
        (9, "http://h/c", page("<p>" + "long " * 50_000 + "</p>")),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).selectExpr("*", "7 AS host", "7 AS path", "7 AS text")
    got = {r.page_id: r for r in html_extract.extract(df).collect()}
    assert got[1].text == "T\n\none & two three" and got[5].text == "kept alone" and got[6].text == got[7].text == "" and got[6].n_chars == 0
    assert got[2].text == "own two" and got[3].text == got[4].text == "own three"
    assert got[8].text == "a\n\nb" and got[9].text == "T\n\n" + ("long " * 50_000).strip() and got[9].n_chars == len(got[9].text)
    assert html_extract.extract(df).count() == len(rows)


@pytest.mark.parametrize(
    "html, text",
    [
        ("<article class='post has-sidebar'><p>kept</p></article>", "kept"),
        ("<main class='search-results'><p>kept</p></main>", "kept"),
        ("<div class='content comments-open'><p>kept</p></div>", "kept"),
        ("<div data-role='banner' data-id='menu' data-class='ad' title='x class=ad'><p>kept</p></div>", "kept"),
        ("<div class='header-wrapper'><p>gone</p><article><p>kept</p></article><p>gone</p></div>", "kept"),
        ("<div class='ad-slot'>gone</div><div class='post-comments'>gone</div><div role='banner'>gone</div><div id='nav_menu'>gone</div><div class='x ad'>gone</div><p>kept</p>", "kept"),
        ("<article><p>kept</p><div class='comments'><article><p>gone</p></article></div></article>", "kept"),
    ],
)
def test_furniture_by_whole_names(html, text):
    assert html_extract.lines_of(html)[0] == [text]


def brute_text(pages, at):
    """Against all other pages of the host in order, one by one."""
    path, lines = pages[at]
    for x in sorted((x for x in range(len(pages)) if x != at), key=lambda x: (-len(os.path.commonprefix([pages[x][0], path])), x > at, abs(x - at))):
        if 0 < len(set(lines) & set(pages[x][1])) < len(set(lines)):
            return html_extract.own_lines(list(lines), list(pages[x][1]))
    return list(lines)


def test_differencing_goes_on_beyond_copies(spark):
    copies = [(i, f"http://h/a/{i:02d}", page("<div>Site line</div><p>copied</p><div>Bottom</div>", False)) for i in range(12)]
    strangers = [(20 + i, f"http://h/a/{i:02d}x", page(f"<p>stranger {i}</p>", False)) for i in range(12)]
    far = [(40, "http://h/z", page("<div>Site line</div><p>far</p><div>Bottom</div>", False))]
    df = spark.createDataFrame([*copies, *copies, *strangers, *far], "page_id long, url string, html string")
    for parts in (1, 7):
        got = [(x.page_id, x.text) for x in html_extract.extract(df.repartition(parts)).collect()]
        assert sorted(got) == sorted([(i, "copied") for i, _, _ in copies * 2] + [(20 + i, f"stranger {i}") for i in range(12)] + [(40, "far")])


def test_marked_pages_are_differenced_too(spark):
    """A mark whose lines the partner has too is the site's, if the page's own lines outside outweigh it; an article's shared passages stay."""
    teaser = "<article class='card'><p>Read this too</p></article><div>Site line</div>"
    shared = "<article><h1>Title</h1><p>a passage that many pages share, and long enough</p></article>"
    rows = [(k, f"http://h/{k}", f"<body>{teaser}<p>the text of page {k}, which nothing marks</p></body>") for k in range(3)]
    rows += [(10 + k, f"http://g/{k}", f"<body>{shared}<p>{k} min</p></body>") for k in range(3)]  # all of the mark is shared, but the rest is slight
    rows += [(20 + k, f"http://f/{k}", f"<body><article><p>shared passage</p><p>own {k}</p></article><p>outside the article, of page {k} alone</p></body>") for k in range(3)]
    rows += [(30, "http://e/1", f"<body>{teaser}<p>no other page on its host to tell</p></body>")]
    wanted = {k: f"the text of page {k}, which nothing marks" for k in range(3)}
    wanted |= {10 + k: "Title\n\na passage that many pages share, and long enough" for k in range(3)}
    wanted |= {20 + k: f"shared passage\n\nown {k}" for k in range(3)} | {30: "Read this too"}
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for most in (html_extract.BROADCAST_BYTES, 0):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(html_extract, "BROADCAST_BYTES", most)
            assert {r.page_id: r.text for r in html_extract.extract(df).collect()} == wanted


@pytest.mark.parametrize("near, block, fan, partitions", [(16, 128, 8, 4), (2, 4, 2, 4), (1, 3, 3, 9), (0, 2, 8, 1)])
def test_partners_depend_on_no_size(spark, monkeypatch, near, block, fan, partitions):
    """Close neighbours, the index of lines, or both, on any number of partitions, give what a search through all pages gives."""
    for name, value in (("NEAR", near), ("BLOCK", block), ("FAN", fan)):
        monkeypatch.setattr(html_extract, name, value)
    r = random.Random(8)
    rows = []
    for k in range(9):
        for _ in range(r.choice([1, 2, 5, 30, 60])):
            kind = r.random()
            lines = [r.choice("uvwxyz") for _ in range(r.randint(0, 4))] if kind < 0.3 else ["same", "copy"] if kind < 0.6 else [f"only {r.random()}"]
            rows.append((f"h{k}", "/" + "".join(r.choice("abé") for _ in range(r.randint(0, 5))), lines, r.random() < 0.9))
    df = spark.createDataFrame(rows, "host string, path string, lines array<string>, open boolean").repartition(partitions)
    got = {(x.host, x.path, x.digest): x.text for x in html_extract.differenced(df).collect()}
    import hashlib

    digest = lambda lines: hashlib.sha256("\n".join(lines).encode()).hexdigest()
    wanted = {}
    for host in {x[0] for x in rows}:
        pages = sorted({(p, tuple(lines)) for h, p, lines, _ in rows if h == host}, key=lambda x: (x[0], digest(x[1])))
        open_ = {(p, tuple(lines)) for h, p, lines, o in rows if h == host and o}
        wanted |= {(host, *[(p, digest(lines)) for p, lines in [x]][0]): "\n\n".join(brute_text(pages, k)) for k, x in enumerate(pages) if x in open_}
    assert got == wanted


def test_hostile_pages_take_linear_time():
    import time

    n, began = 200_000, time.perf_counter()
    for html in ("<b>" * n + "</i>" * n, "<i><div>" + "<b>" * n + "</i>" * n, "<b>" * n + "<p>" * n, "<a " * n, "<a " * n + ">", "<a '\">" * n, "<a x='b\" y=\"c>" * n, "<!--" * n, "<p>x" * n, "<![CDATA[" * n, "<" * n + ">", "</p" * n, "<!" * n, "&amp" * n):
        html_extract.lines_of(html)
    one = ["x"] * 40_000
    assert html_extract.common_lines(one[:-1] + ["y"], ["z", *one]) == list(range(39_999))
    mixed = ["ab"[i % 2] for i in range(60_000)]
    assert len(html_extract.common_lines(mixed, mixed[1:] + ["c"] + mixed[:7])) == 60_000
    assert time.perf_counter() - began < 60


def test_differencing_alone(spark):
    """What the method gives without structure on the test pages; README has the figures."""
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    alone = {r.page_id: r.text for r in html_extract.extract(pages, structure=False).collect()}
    assert len(alone) == pages.count() and sum(map(bool, alone.values())) > 0


def test_common_lines_is_a_longest_common_subsequence():
    r = random.Random(6)
    for _ in range(300):
        a, b = ([r.choice("abc") for _ in range(r.randint(0, 9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        got = html_extract.common_lines(a, b)
        it = iter(b)
        assert len(got) == best[-1][-1] and got == sorted(set(got)) and all(a[i] in it for i in got)


def test_test_pages(spark):
    """The article's paragraphs, read independently from the test pages' known layout."""
    import re
    from html import unescape

    for row in html_extract.extract(spark.read.parquet(f"{DATA}/pages.parquet")).join(spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search("<article>(.*?)</article>", row.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1|li|ul|div)\b[^>]*>", article)]
        assert row.text == "\n\n".join(b for b in blocks if b)


# --- every operator and stage on awkward and on empty tables ---

OPERATORS = {
    "pii": pii.personal_data,
    "rules": rules.quality_features,
    "keep_good": rules.keep_good,
    "encode": bpe_ops.encode,
    "round_trip": bpe_ops.round_trip,
    "mixing": mixing.words_taken,
    "quality": lambda d: weak_quality.score(d, weak_quality.learn(d)[1]),
    "near": minhash.near_duplicates,
    "language": lambda d: langid.predict(d, langid.prototypes(d)),
    "secrets": lambda d: secrets.digest(secrets.findings_of(d)),
    "redact": secrets.redact,
}


def test_pages_of_no_rows_or_nulls(spark):
    kind = "page_id long, url string, html string, host string, path string, lines string, rank int"
    assert html_extract.extract(spark.createDataFrame([], kind)).collect() == []
    nulls = html_extract.extract(spark.createDataFrame([(None,) * 7] * 3, kind)).collect()
    assert [tuple(r) for r in nulls] == [(None, None, "", 0)] * 3


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_and_empty_tables(spark, name):
    f = OPERATORS[name]
    full = documents(spark, awkward(), extra=True)
    assert f(full).count() == (len(awkward()) if name != "keep_good" else f(full).count())
    assert f(full.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None,) * 5] * 3, SCHEMA)
    assert f(nulls).count() == (0 if name == "keep_good" else 3)


def test_last_stage_decodes(spark):
    import hashlib

    rows = [r for r in awkward() if r[0] is not None]
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.STAGES[-1][1](spark, documents(spark, rows), DATA).collect()}
    assert got == {r[0]: hashlib.sha256((r[1] or "").encode()).hexdigest() for r in rows}


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, k):
    name, stage = corpus_pipeline.STAGES[k]
    for docs in (documents(spark, awkward(), extra=True), documents(spark, awkward()), spark.createDataFrame([], SCHEMA), spark.createDataFrame([(None,) * 5] * 3, SCHEMA)):
        out = stage(spark, docs, DATA)
        out.collect()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns


def test_pipeline_against_brute_force(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    good = [d for d in docs if rules.passes(rules.Text((d[1] or "").encode()), list(rules.RULES))]
    near = brute_near([(i, t) for i, t, _ in good])
    kept = {i: (t, s) for i, t, s in good if near[i][2]}
    import base64
    import re

    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, DATA).collect():
        got[r.doc_id].append(r.ids)
    secret = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8,}|AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}""")
    clean = {i: t for i, (t, _) in kept.items() if not secret.search(t)}
    assert set(got) <= set(kept)
    for i, lists in got.items():
        assert 1 <= len(lists) <= 2 and all(x == lists[0] for x in lists)
        if i in clean:
            assert lists[0] == library.encode_ordinary(clean[i])
        else:
            assert not secret.search(library.decode(lists[0])) and "<" in library.decode(lists[0])
    sizes, taken = defaultdict(int), defaultdict(int)
    redacted = {i: len(words(library.decode(got[i][0]) if i in got else t)) for i, (t, _) in kept.items()}
    for i, (_, s) in kept.items():
        sizes[s] += redacted[i]
        taken[s] += redacted[i] * len(got.get(i, ()))
    most = max(redacted.values())
    assert all(abs(taken[s] - t) <= most for s, t in brute_targets(sizes).items())


def test_extra_names_are_really_clashing():
    assert "target" in EXTRA and "_row" in EXTRA
