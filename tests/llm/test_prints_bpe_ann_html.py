"""Fingerprints (op3), byte-level BPE (op9), nearest neighbours (op8) and HTML extraction (op4)."""

import base64
import hashlib
import json

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from touchline.llm import ann, byte_bpe, queries, simhash, wrappers

SF001 = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = ["", None, " ", "   ", "a  b", "a   b\n\n  c", "\n \n", "don't  we'll 'S", "x" * 3000, "tab\tand nbsp   em\x1c\x85", "日本語 テスト", "👍🏽 é", " lead", "trail ", "12 3.5%%% &&&"]


def check_prints(out, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = sorted(out, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    texts = [t or "" for _, t in rows]
    want = []
    for i, (key, _) in enumerate(rows):
        text, after = texts[i], texts[(i + 1) % len(texts)]
        changed = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        own, other, following = (simhash.fingerprint(t) for t in (text, changed, after))
        want.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), own.hex(), other.hex(), simhash.likeness(own, other), simhash.likeness(own, following)))
    assert sorted(map(str, want)) == sorted(str(tuple(r[c] for c in simhash.NAMES)) for r in got)


def test_fingerprints_equal_a_plain_loop(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    out = [r.asDict() for r in queries.op3_simhash_fingerprints(spark, SF001).collect()]
    check_prints(out, docs)
    by_id = {r["doc_id"]: r for r in out}
    prints = [int(r["fingerprint"], 16) for r in out]
    for key, row in by_id.items():
        near = sum((int(row["fingerprint"], 16) ^ p).bit_count() <= 3 for p in prints)
        assert row["n_within_3"] == (near if key % 100 == 0 else None)
    long = [r for r in out if r["n_chars"] > 400]
    assert np.mean([r["near_edited"] > r["near_next"] for r in long]) > 0.98


def test_fingerprints_odd_rows(spark):
    rows = list(enumerate(ODD)) + [(None, "n"), (None, "m"), (2, "tie"), (2, "tie")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit("clash")).repartition(9)
    check_prints([r.asDict() for r in simhash.fingerprints_with_next(df).collect()], rows)
    one = simhash.fingerprints_with_next(df.filter("doc_id = 8")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert simhash.fingerprints_with_next(df.limit(0)).count() == 0


def test_fingerprint_parts_and_radius(spark, monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(2000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PART", 64)
    monkeypatch.setattr(simhash, "VOTE", 50)
    assert simhash.fingerprint(text) == whole
    rng = np.random.default_rng(1)
    base = int.from_bytes(whole)
    near = {f"{base ^ sum(1 << int(b) for b in rng.choice(128, k, replace=False)):032x}" for k in (0, 1, 2, 3, 3, 4, 5) for _ in range(4)}
    df = spark.createDataFrame([(p,) for p in near], "fingerprint string")
    got = {(r.query, r.found, r.apart) for r in simhash.within_radius(df, df).collect()}
    assert got == {(a, b, d) for a in near for b in near if (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= 3}


def plain_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark):
    plain = plain_encoding()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in queries.op9_distinct_word_bpe(spark, SF001).collect():
        ids = plain.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_odd_rows_and_small_blocks(spark):
    plain = plain_encoding()
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(ODD)] + [(3, ODD[3], "c")], "doc_id long, text string, block string").repartition(3)
    out = byte_bpe.encode_documents(df, RANKS, public_tokenizers.PATTERN, block_chars=20)
    found = [(r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in out.collect()]
    assert len(found) == len(ODD) + 1
    assert all(ids == plain.encode_ordinary(ODD[i] or "") for i, ids in found)
    back = {r.doc_id: r.text for r in byte_bpe.decode_documents(out, RANKS, public_tokenizers.PATTERN).collect()}
    assert back == {i: t or "" for i, t in enumerate(ODD)}
    assert byte_bpe.encode_documents(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def brute_force(rows, is_query, k):
    out = {}
    for key, vec in rows:
        if is_query(key):
            scored = sorted(((-float((np.array(vec) * np.array(v)).sum()), i) for i, v in rows if i != key))
            out[key] = [(i, -s) for s, i in scored[:k]]
    return out


def test_neighbours_exact_when_all_cells_are_visited(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6) * rng.uniform(0.1, 3)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)]  # a hot vector, ties by id
    bad = [(-20, None), (-40, [0.0] * 6), (-60, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (-80, [float("nan")] * 6), (-100, [float("inf")] + [0.0] * 5), (-120, [1.0])]
    df = spark.createDataFrame([(*r, "c") for r in rows + bad], "vec_id long, embedding array<double>, cell string").repartition(5)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, k=20, share=1.0, part_rows=7, centroids=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute_force(rows, lambda i: i % 20 == 0, 20)
    assert {q: [i for i, _ in found] for q, found in got.items()} == {q: [i for i, _ in found] for q, found in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in want for a, b in zip(got[q], want[q]))


def test_neighbours_recall_and_few_rows(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    want = brute_force(rows, lambda i: i % 20 == 0, 20)
    vectors = spark.read.parquet(f"{SF001}/embeddings.parquet")
    found = ann.search(vectors, F.col("vec_id") % 20 == 0, k=20, least=100).collect()
    hits = sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in found)
    assert hits >= 0.9 * sum(len(v) for v in want.values())
    few = ann.search(vectors.filter("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert sorted(r["rank"] for r in few) == [1, 2]
    assert ann.search(vectors.limit(0), F.col("vec_id") == 0).count() == 0


def test_a_query_goes_once_to_each_run_in_small_batches():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 8))
    books = ann.Codebooks(x, float((x ** 2).sum(1).max()), 16)
    cells = books.cells(x)
    sizes = np.bincount(cells, minlength=256)
    sizes[int(cells[0])] += 900  # a hot cell
    layout = (sizes, *ann.runs_of_cells(sizes, 400, 600))
    runs = np.searchsorted(layout[1], np.arange(256), side="right") - 1
    for r in range(len(layout[1])):
        held = sizes[runs == r].sum()
        assert layout[2][r] == 1 and held <= 600 or (runs == r).sum() == 1 and -(-held // 400) == layout[2][r]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array(list(x))], names=["vec_id", "vec"])
    enough, met = int(0.65 * sizes.sum()), {}
    for out in ann.visits_of_runs(iter([batch]), books, layout, enough):
        assert out.num_rows <= ann.PAIRS  # all visits of 3,000 queries were one table before
        for q, run, part, bits in zip(*(out.column(c).to_pylist() for c in ("query_id", "q_run", "q_part", "visited"))):
            assert (run, part) not in met.setdefault(q, {})
            met[q][run, part] = np.flatnonzero(np.unpackbits(np.frombuffer(bits, dtype=np.uint8))) + layout[1][run]
    for q, want in enumerate(books.visits(x, sizes, enough)):
        assert {(r, p) for c in want for r in [runs[c]] for p in range(layout[2][r])} == set(met[q])
        assert {int(c) for own in met[q].values() for c in own} == set(want)


def test_heap_walk_is_in_order():
    rng = np.random.default_rng(4)
    a, b = rng.random(9), rng.random(7)
    cells = ann.walk(a, b, np.ones(63, dtype=int), 63)
    sums = [a[c // 7] + b[c % 7] for c in cells]
    assert len(set(cells)) == 63 and sums == sorted(sums)


PAGE = ("<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/a'>A</a><li><a href=\"/b>c\">B</a></ul></nav>"
        "<div class='cookie-notice'>We use cookies</div><main><article id=post-%d><h1>Head &amp; %d</h1><p>One <b>bold<br>line</b>\n two<p>Three &copy; %d</p>"
        "<div class='ad'>Buy</div><form><p>Mail</p></form><ul><li>x%d<li>y</ul><section class=comments><p>Nice</p></section></article></main>"
        "<aside>Side</aside><script>var t='</p>';</script><footer>Foot</footer>")


def test_wrapper_finds_the_article(spark):
    rows = [(i, f"http://h{i % 2}.example.com/{i}", PAGE % (i, i, i, i)) for i in range(6)] + [(7, None, None), (8, "x", ""), (8, "x", ""), (9, "http://h0.example.com/", "<p>cut &am")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("wrapper", F.lit("clash")).repartition(4)
    out = {r.page_id: r.text for r in wrappers.main_texts(df).collect()}
    assert out[3] == "Head & 3\n\nOne bold line two\n\nThree © 3\n\nx3\n\ny"
    assert out[7] == out[8] == "" and wrappers.main_texts(df).count() == len(rows)
    assert wrappers.main_texts(df.limit(0)).count() == 0


def test_pages_of_one_host_are_read_by_their_own_layout(spark):
    layouts = ["<body><nav>Menu</nav><article><h1>A%d</h1><p>Text %d</p></article>", "<body><nav>Menu</nav><main><h1>M%d</h1><p>Words %d</p></main>",
               "<body><nav>Menu</nav><div id=content><h1>D%d</h1><p>Body %d</p></div>"]
    rows = [(i, "http://mixed.example.com/", layouts[i % 3] % (i, i)) for i in range(12)] + [(12, "odd", layouts[0] % (12, 12)), (13, None, "<p>cut &am")]
    out = {r.page_id: r.text for r in wrappers.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    for i in range(12):
        assert out[i] == ("A%d\n\nText %d", "M%d\n\nWords %d", "D%d\n\nBody %d")[i % 3] % (i, i)
    assert out[12] == "A12\n\nText 12" and out[13] == "cut &am"


def read_by_own_rules(page, n=5):
    whole = wrappers.expression(page.replace("%d", "0"))
    for i in range(1, n):
        whole = wrappers.merge(whole, wrappers.expression(page.replace("%d", str(i))))
    return wrappers.Rules(json.loads(json.dumps(whole))).text(page.replace("%d", "9"))


def test_class_words_do_not_discard_the_article():
    rest = "<div>Other block %d of the page, with more text than the article has, much more</div>"
    for opened in ("<div class='site has-sidebar'><article>", "<main class=no-sidebar>", "<article class='post comments-open'>", "<div id=search-content><article>",
                   "<article class=related>", "<div class=widget><article>", "<form id=page><main>"):
        closed = "</article>" if "<article" in opened else "</main>"
        page = "<body>" + opened + "<h1>T%d</h1><p>Text %d</p><div class='widget-3'>Off</div><aside>Side</aside>" + closed + "</div>" * ("<div" in opened) + "</form>" * ("<form" in opened) + rest
        assert read_by_own_rules(page) == "T9\n\nText 9", opened
    page = "<body><div id=search-content><p>Text %d</p></div><div class='sidebar'>Side %d, a longer text than that of the page</div>"
    assert read_by_own_rules(page) == "Text 9"
    nested = "<article><p>Text %d</p><article class=comment><p>Nice %d</p></article></article><div class=related><article>Teaser %d</article></div>"
    assert read_by_own_rules(nested) == "Text 9"


def test_article_in_sibling_containers_is_whole():
    page = ("<body><div class=top>Site name</div><div id=all><div class=title><h1>Head %d</h1></div><section id=intro><p>First part %d</p></section>"
            "<section id=methods><p>Second part %d, the longest of all</p><p>More %d</p></section></div><div><a href=x>Link %d</a></div>")
    assert read_by_own_rules(page) == "Head 9\n\nFirst part 9\n\nSecond part 9, the longest of all\n\nMore 9"


def test_template_text_is_dropped_where_nothing_names_the_region():
    page = "<body><div class=top>Site name</div><div id=box><p>Same notice</p><h2>T%d</h2><p>Body %d is long enough</p><p>More %d</p></div><div><a href=x>Link %d</a></div>"
    whole = wrappers.expression(page % (0, 0, 0, 0))
    for i in range(1, 5):
        whole = wrappers.merge(whole, wrappers.expression(page % (i, i, i, i)))
    rules = wrappers.Rules(json.loads(json.dumps(whole)))
    assert rules.text(page % (9, 9, 9, 9)) == "T9\n\nBody 9 is long enough\n\nMore 9"


def test_inference_makes_optional_and_repeated_groups():
    a, b = wrappers.expression("<ul><li>x<li>y</ul><p>t"), wrappers.expression("<ul><li>x</ul><div>n</div><p>t<p>u")
    assert wrappers.as_regex(wrappers.merge(a, b)) == "(<ul> (<li> # </>)+ </> (<div> # </>)? (<p> # </>)+)"
    pairs = wrappers.expression("<dl><dt>a<dd>b<dt>c<dd>d</dl>")
    assert wrappers.as_regex(pairs) == "(<dl> ((<dt> # </> <dd> # </>))+ </>)"


def test_extraction_equals_a_plain_reading(spark):
    import html
    import re
    for r in queries.op4_wrapper_inference(spark, SF001).join(spark.read.parquet(f"{SF001}/pages.parquet"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)
