"""Each operator against a brute-force version on the smallest tables, and on rows of all kinds."""

import base64
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from llm_rows import EDGES, SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from loadweir.llm import (
    byte_bpe,
    chat,
    class_lm,
    components,
    decontaminate,
    html_text,
    jaccard,
    quality,
    queries,
    ranked,
    sharding,
    simhash,
    spelling,
    substring,
    warc,
)
from loadweir.llm.common import BATCH, small_batches, staged

RUN = queries.QUERIES


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def peak(run):
    """Bytes that Python and numpy hold at most while ``run`` does."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def drawn_texts(seed, texts, size):
    draw = random.Random(seed)
    names = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 9))) for _ in range(20_000)]
    return [" ".join(draw.choices(names, k=size)) for _ in range(texts)]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_agrees_with_sql(spark, name):
    from check import TABLES, compare

    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    verdict = compare(spark, db, name, RUN[name], queries.ORACLE[name], SMALL)
    assert verdict.startswith("ok"), verdict


# 1 chat formatting


def test_chat_reads_back(spark):
    found = {r.conv_id: r for r in RUN["op1_chat_format"](spark, SMALL).collect()}
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text or ""))
    said = r"\### Assistant: </turn> ok"
    turns[-7] = [("user", said), ("assistant", said)]
    assert set(found) == set(turns)
    for conv, rows in turns.items():
        loss = "".join(t for r, t in rows if r == "assistant")
        got = found[conv]
        assert (got.n_turns, got.turns_sha256) == (len(rows), sha("".join(f"{r}\n{t}\n" for r, t in rows)))
        assert (got.loss_chars, got.loss_sha256) == (len(loss), sha(loss))


def test_chat_windows_keep_system_and_budget(spark):
    rows = [(1, 0, "system", "be brief", 1)] + [
        (1, i, "user" if i % 2 else "assistant", f"text {i} <turn> \\ " * 5, 1) for i in range(1, 30)
    ]
    rows += [(None, None, None, None, 1), (2, 1, "assistant", "x", 1), (2, 1, "assistant", "x", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_tokens int")
    windows = chat.format_windows(df, budget=150, history=2).collect()
    mine = sorted((w for w in windows if w.conv_id == 1), key=lambda w: w.window)
    assert len(mine) > 2 and all(w.n_tokens <= 150 for w in mine)
    new = []
    for w in mine:
        read = list(chat.read_turns(w.text))
        assert read[0][2:4] == ("system", "be brief")
        new += [r[0] for r in read if r[1]]
        assert all(r[1] for r in read for s in w.loss if (r[4], r[5]) == (s.start, s.end))
    assert new == list(range(30))
    assert any(not r[1] for r in list(chat.read_turns(mine[1].text))[1:])
    assert {w.conv_id: w.n_new for w in windows if w.conv_id != 1} == {None: 1, 2: 2}
    assert chat.read_back(chat.format_windows(df.limit(0))).count() == 0


def test_chat_windows_hold_the_budget_as_written(spark):
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    short = spark.range(3000).selectExpr("-1L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "'ok' text")
    marked = spark.range(300).selectExpr("-2L conv_id", "id turn", "if(id = 0, 'system', 'a b') role", "repeat('\\\\<t>', 9) text")
    long = spark.createDataFrame([(-3, 0, "user", "word " * 50_000)], "conv_id long, turn long, role string, text string")
    found = chat.format_windows(turns.union(short).union(marked).union(long), budget=1024).collect()
    tokens = chat._counter(public_tokenizers.path(chat.VOCABULARY))
    over = 0
    for w in found:
        assert w.n_tokens == len(tokens.encode(w.text, add_special_tokens=False).ids)
        if w.n_tokens > 1024:
            assert w.n_new == 1 and all(r[1] or r[2] == "system" for r in chat.read_turns(w.text))
            over += w.conv_id == -3
    assert over == 1 and sum(w.conv_id == -1 for w in found) > 20


# 2 html


PAGE = (
    "<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href=/>Home</a>"
    "</nav><div class='cookie-notice'>We use cookies.</div><article><h1>A &amp; b</h1><p>Hello  <i>wor</i>ld.<p>Two<br>"
    "lines &copy; x</p><div class=ad>Buy</div><script>var t='</p>';</script><ul><li>one<li>two</ul>"
    "<section class=comments><p>Nice!</p></section><form><label>Mail</label></form></article>"
    "<aside>Side bar.</aside><!-- no --><footer>&copy; me</footer></body></html>"
)


def test_html_main_text(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    model = html_text.train(pages)
    assert model.extract(PAGE) == "A & b Hello world. Two lines © x one two"
    unmarked = PAGE.replace("<article", "<div class=content").replace("</article", "</div")
    assert model.extract(unmarked) == model.extract(PAGE)
    rows = [(1, None), (2, ""), (3, "<nav>menu</nav><p"), (4, PAGE), (4, PAGE)]
    odd = spark.createDataFrame([(i, "u", h, "old") for i, h in rows], "page_id long, url string, html string, text string")
    got = Counter((r.page_id, r.text) for r in html_text.extract(odd, model).collect())
    assert got == Counter({(1, ""): 1, (2, ""): 1, (3, ""): 1, (4, model.extract(PAGE)): 2})
    assert html_text.train(odd.limit(0)).extract(PAGE) == model.extract(PAGE)


def test_html_references_end_at_tags():
    assert [text for _, text, _ in html_text.blocks("<p>a&<b>lt;</b> &amp;<i>amp;</i> x&lt;y</p>")] == ["a&lt; &amp; x<y"]


def test_html_trains_on_whole_pages_and_on_a_sample(spark):
    long = "<article>" + "<p>A sentence of the article.</p>" * 700 + "</article><p>no end</p>" * 300
    assert len(html_text.blocks(long)) == 1000
    assert html_text.fit([long]).extract(long).count("sentence") == 700
    pages = spark.range(50).selectExpr("id page_id", "concat('<article><p>Page ', id, '.</p></article><p>menu</p>') html")
    seen, fit = [], html_text.fit
    html_text.fit = seen.extend
    try:
        html_text.train(pages, sample=5)
        html_text.train(pages, sample=5, most_chars=10)
    finally:
        html_text.fit = fit
    assert len(seen) == 5


def test_html_whole_table(spark):
    import html

    for r, p in zip(
        RUN["op2_html_text"](spark, SMALL).orderBy("page_id").collect(),
        spark.read.parquet(f"{SMALL}/pages.parquet").orderBy("page_id").collect(),
    ):
        body = re.search(r"<article>(.*?)</article>", p.html or "", re.DOTALL)
        text = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)[^>]*>", " ", body.group(1))) if body else ""
        assert r.text == " ".join(html.unescape(text).split()) and r.n_chars == len(r.text)


def test_viterbi_is_best():
    draw = random.Random(1)
    for _ in range(50):
        crf = html_text.Crf({}, np.array([[draw.gauss(0, 1) for _ in range(2)] for _ in range(2)]))
        scores = [draw.gauss(0, 2) for _ in range(6)]

        def value(labels):
            return sum(s for s, x in zip(scores, labels) if x) + sum(crf.pairs[a, b] for a, b in zip(labels, labels[1:]))

        best = max(value([k >> i & 1 for i in range(6)]) for k in range(64))
        assert value(crf.decode(scores)) == pytest.approx(best)


# 3 language model


def test_lm_base_and_held_out(spark, texts):
    rows = {r.doc_id: r for r in RUN["op3_class_lm"](spark, SMALL).collect()}
    tokens = {d: lower(t).encode().split() + [b"\n"] for d, t in texts.items()}
    train = Counter(w for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 10 for w in ws)
    n, v = sum(train.values()), len(train)
    for d, ws in tokens.items():
        r = rows[d]
        assert r.base_score == pytest.approx(sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(train[w] > 0 for w in ws), n)
        assert r.held_out == (zlib.crc32(str(d).encode()) % 10 == 0)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_probabilities_add_up():
    ids = class_lm.Ids([(b"a", 5), (b"b", 4)], 3)
    classes = np.concatenate([[0, 1], class_lm.CLASSES + np.arange(ids.size - 2)])
    matrix = np.zeros((class_lm.CLASSES + ids.size - 2,) * 2)
    matrix[class_lm.CLASSES, 0], matrix[0, 1], matrix[1, class_lm.CLASSES] = 5, 4, 3
    model = class_lm.Model(ids, classes, matrix, 12, 3, 1)
    assert (10**model.moves).sum(axis=1) == pytest.approx(np.ones(len(matrix)))


def test_lm_edges(spark, edges):
    rows = class_lm.score(edges).collect()
    assert len(rows) == len(EDGES)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert class_lm.score(edges.limit(0)).count() == 0


def test_lm_words_seen_once_have_classes(spark, monkeypatch):
    """Words seen once go to classes by their neighbours, also when those who ask for them are in other parts."""
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 10]
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts = [f"red x{i} sun blue y{i} sea red cat sun blue oak sea" for i in range(60)]
    asked = ["red x7 sun", "red y7 sun", "blue x7 sea", "blue y7 sea", "x9", "new x7"]
    df = spark.createDataFrame([*zip(ids, texts), *zip(held, asked)], "doc_id long, text string")
    whole = {r.doc_id: r.score for r in class_lm.score(df).collect()}
    x_red, y_red, x_blue, y_blue = (whole[i] for i in held[:4])
    assert x_red > y_red + 0.5 and y_blue > x_blue + 0.5
    monkeypatch.setattr(class_lm, "PART_BYTES", 100)
    assert {r.doc_id: r.score for r in class_lm.score(df).collect()} == pytest.approx(whole)


# 4 warc


def test_warc_whole_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    last = {}
    for i, r in pages.items():
        last[r.html or ""] = max(i, last.get(r.html or "", i))
    rows = sorted(RUN["op4_warc"](spark, SMALL).collect(), key=lambda r: (r.range, r.position))
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        raw, top = (pages[r.page_id].html or "").encode(), last[pages[r.page_id].html or ""]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if top == r.page_id else ("revisit", top))
        assert r.url_key == warc.url_key(pages[r.page_id].url or "")
    # the merge gives one order over all ranges
    order = [(r.url_key, r.captured) for r in rows]
    assert order == sorted(order) and len({r.range for r in rows}) > 1


@pytest.mark.parametrize("step", [1, 7, 1000, 1 << 20])
def test_warc_archives_are_read_in_steps(step):
    import gzip

    bodies = ["", "a", "\r\n\r\n" * 9, "WARC/1.1\r\n\r\n", "é" * 5000, "x" * 300]
    made = [warc.record(str(i), "u", "t", b, "D", None).encode() + b"\r\n\r\n" for i, b in enumerate(bodies)]
    want = [(sum(map(len, made[:i])), len(m), b.encode()) for i, (m, b) in enumerate(zip(made, bodies))]
    # as one member, and as a member for each record
    for packed in (gzip.compress(b"".join(made)), b"".join(map(gzip.compress, made))):
        found = list(warc.parse(warc.unpacked(memoryview(packed), step)))
        assert [(at, n, payload) for at, n, _, payload in found] == want
        with pytest.raises(ValueError):
            list(warc.parse(warc.unpacked(memoryview(packed[:-9]), step)))
    assert list(warc.parse(warc.unpacked(memoryview(b""), step))) == []
    for broken in (b"x" * 100, made[1][:-1], made[1] + b"WARC"):
        with pytest.raises(ValueError):
            list(warc.parse([broken[i : i + step] for i in range(0, len(broken), step)]))


def test_warc_revisits_and_history(spark):
    rows = [(1, "http://b.com/x", "<p>same"), (3, "http://a.com/", "<p>same"), (2, None, "<p>same")]
    rows += [(4, "http://a.com/\r\nX: y", "a\r\n\r\nWARC/1.1 é"), (5, "u", None), (6, "u", ""), (3, "http://a.com/", "<p>same")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, archive string")
    found = warc.archive_and_index(pages, F.timestamp_seconds("page_id")).collect()
    assert len(found) == len(rows)
    for r in found:
        html = next(h for p, _, h in rows if str(p) == r.record_id) or ""
        assert r.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert r.payload_bytes == len(html.encode())
    kinds = Counter((r.record_id, r.record_type, r.refers_to) for r in found)
    assert kinds[("3", "response", None)] == 1 and kinds[("3", "revisit", "3")] == 1
    assert kinds[("1", "revisit", "3")] == kinds[("2", "revisit", "3")] == kinds[("5", "revisit", "6")] == 1
    ordered = sorted(found, key=lambda r: (r.range, r.position))
    keys = [(r.url_key, r.captured, r.archive, r.offset) for r in ordered]
    assert keys == sorted(keys)
    assert warc.archive_and_index(pages.limit(0), F.timestamp_seconds("page_id")).count() == 0


def test_loser_tree():
    draw = random.Random(2)
    for _ in range(200):
        runs = [sorted((draw.randint(0, 9),) for _ in range(draw.randint(0, 8))) for _ in range(draw.randint(0, 9))]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(sum(runs, []))


# 5 substring dedup


def brute_cut(texts, width):
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("part_bytes", [200, 1 << 20])
def test_cut_is_exact(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(substring, "PART_BYTES", part_bytes)
    draw = random.Random(3)
    texts = [" ".join(draw.choice("abc") for _ in range(draw.randint(0, 30))) for _ in range(60)] + [None, "", "a b"]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = [(r.n_words, r.n_removed, r.kept) for r in substring.cut_repeats(df, width=5).orderBy("doc_id").collect()]
    assert got == brute_cut(texts, 5)


def test_cut_edges(spark, edges):
    got = substring.cut_repeats(edges, width=8)
    assert got.count() == len(EDGES) and set(edges.columns) < set(got.columns)
    assert {r.kept for r in got.where("doc_id in (5, 7)").collect()} == {""}
    assert substring.cut_repeats(edges.limit(0)).count() == 0


def test_windows_of_a_part_take_little_memory():
    texts = drawn_texts(5, 300, 1000)
    assert peak(lambda: substring.Windows(texts, 35, 8)) < 20 * sum(map(len, texts))


@pytest.mark.parametrize("width", [4, 16])
def test_repeated_keys_are_found_in_little_memory(width):
    draw = np.random.default_rng(5)
    keys = draw.integers(0, 1 << 20, (400_000, width // 4)).astype(np.uint32)
    keys[1000:3000] = keys[200_000:202_000]
    many = draw.random(len(keys)) < 0.01
    ends = [0, 70_000, 70_001, 250_000, 400_000]
    rows = [(3, p, keys[a:b].tobytes(), substring._bits(many[a:b])) for p, (a, b) in enumerate(zip(ends, ends[1:]))]
    names = ["bucket", "part", "keys", "many"]
    halves = [pa.table([pa.array(c) for c in zip(*some)], names) for some in (rows[:3], rows[3:])]
    table, found = pa.concat_tables(halves), []
    assert peak(lambda: found.append(substring._repeated(width)(table))) < keys.nbytes + 40 * len(keys)
    seen = Counter()
    for key, twice in zip(map(bytes, keys), many):
        seen[key] += 1 + int(twice)
    got = {r["part"]: r["hits"] for r in found[0].to_pylist()}
    for p, (a, b) in enumerate(zip(ends, ends[1:])):
        want = np.array([seen[bytes(k)] > 1 for k in keys[a:b]])
        assert got.get(p) == (substring._bits(want) if want.any() else None)


def test_small_batches_bound_what_travels_at_once(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows]})

    rows = spark.range(0, 12, 1, 1).select(F.expr("repeat('x', 1 << 20)").alias("text"))
    before = spark.conf.get(BATCH)
    with small_batches(spark):
        got = [r.rows for r in rows.mapInArrow(run, "rows long").collect()]
    assert sum(got) == 12 and max(got) <= 4 and spark.conf.get(BATCH) == before


# 6 simhash


def brute_components(found, radius):
    nodes = sorted(found)
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (found[a] ^ found[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_simhash_whole_table(spark, texts):
    prints = {}
    for d, t in texts.items():
        w = words(lower(t))
        shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    wanted = brute_components(prints, 4)
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in RUN["op6_simhash"](spark, SMALL).collect()}
    assert got == {d: (prints[d], wanted[d]) for d in prints}


def test_links_lose_none(spark):
    draw = random.Random(4)
    seeds = [draw.getrandbits(64) for _ in range(6)]
    prints = {s ^ sum(1 << draw.randrange(64) for _ in range(draw.randint(0, 5))) & (2**64 - 1) for s in seeds for _ in range(15)}
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    df = staged(spark.createDataFrame([(s,) for s in signed], "fp long"), "prints")
    wanted = brute_components({s: s & (2**64 - 1) for s in signed}, 4)
    assert {r.fp: r.root for r in simhash.linked(df).collect()} == wanted


def test_keep_one(spark, edges):
    base = [f"w{i}" for i in range(200)]
    near = base[:100] + ["changed"] + base[101:]
    more = spark.createDataFrame([(20, " ".join(base)), (21, " ".join(near))], "doc_id long, text string")
    docs = edges.unionByName(more, allowMissingColumns=True)
    kept = [r.doc_id for r in simhash.keep_one(docs).collect()]
    assert simhash.fingerprint(" ".join(base), 4) ^ simhash.fingerprint(" ".join(near), 4) != 0
    assert sorted(kept, key=str) == sorted([1, 4, 5, 6, 7, 20, None], key=str)
    assert simhash.keep_one(edges.limit(0)).count() == 0


def test_dense_groups_make_linear_links(spark, monkeypatch):
    """Rows of links stay in proportion to the size of a group of fingerprints near each other."""
    made = []
    whole = simhash.components
    monkeypatch.setattr(simhash, "components", lambda edges: made.append(edges.count()) or whole(edges))
    draw = random.Random(5)
    for n in (100, 800):
        made.clear()
        prints = set()
        while len(prints) < n:
            prints.add((1 << 40) ^ sum(1 << p for p in draw.sample(range(24), 3)))
        df = spark.createDataFrame([(p,) for p in prints], "fp long")
        assert simhash.linked(df).select("root").distinct().count() == 1
        assert sum(made) <= 5 * n, made


# 7 sharding


def test_shards_are_even_and_together(spark, texts):
    rows = RUN["op7_sharding"](spark, SMALL).collect()
    by_shard = defaultdict(list)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        by_shard[r.shard].append(r.slot)
    assert len(rows) == len(texts) and set(by_shard) <= set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1


def test_hot_group_fills_few_shards(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same', cast(id div 2 as string)) as text", "1 as row")
    rows = sharding.shard_documents(docs, shards=8).collect()
    assert len({r.shard for r in rows if r.doc_id % 3 == 0}) <= 4
    assert len(Counter(r.shard for r in rows)) == 8 and set(Counter(r.shard for r in rows).values()) == {500}


def test_rounds_move_whole_groups_out_of_full_shards(spark):
    hub = "if(id % 3 = 0, 'same', concat('h', cast(id div 24 as string)))"
    docs = spark.range(6000).selectExpr("id as row", f"md5({hub}) as hub")
    docs = staged(docs, "docs")
    start = {r.row: r.shard for r in sharding.propagate(docs, 8, 750, 0).collect()}
    end = {r.row: r.shard for r in sharding.propagate(docs, 8, 750, 6).collect()}
    assert sum(start[r] != end[r] for r in start) > 100
    parts = defaultdict(set)
    for row, shard in end.items():
        parts[0 if row % 3 == 0 else row // 24 + 1].add(shard)
    assert all(len(p) == 1 for p in parts.values())
    cut = sharding.cut(sharding.balance(docs.select("row"), docs, 8), docs).where("parts > 1").collect()
    assert sum(r.members == 16 for r in cut) <= 12  # of 250; the hot one has to be cut


def test_shard_edges(spark, edges):
    assert sharding.shard_documents(edges).count() == len(EDGES)
    assert sharding.shard_documents(edges.limit(0)).count() == 0


# 8 byte-level BPE


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_whole_table(spark, texts, reference):
    for r in RUN["op8_byte_bpe"](spark, SMALL).collect():
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert r.decoded_sha256 == sha(texts[r.doc_id])


def test_bpe_odd_texts(reference):
    made = byte_bpe.Pieces(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN, True)
    draw = random.Random(5)
    texts = [chr(c) + "a " + chr(c) * 2 for c in range(1, 0x3000)] + ["日本 \U0001f642'll", "<|endoftext|>", ""]
    for _ in range(500):
        base = "".join(draw.choice("ab =-_\n\té中'0") for _ in range(draw.randint(1, 3)))
        texts.append(base * draw.randint(1, 40))
    sizes, (ids, starts, ends) = made.encode(texts)
    at = 0
    for text, n in zip(texts, sizes):
        assert ids[at : at + n].tolist() == reference.encode_ordinary(text)
        assert n == 0 or (starts[at], ends[at + n - 1]) == (0, len(text))
        at += n


def test_bpe_edges(spark, edges, reference):
    rows = byte_bpe.decode(byte_bpe.encode(edges)).collect()
    assert Counter(r.decoded_text for r in rows) == Counter(t or "" for _, t in EDGES)
    assert all(r.decoded == (r.text or "").encode() for r in rows)
    ids = reference.encode_ordinary("\U0001f642é")
    assert "".join(byte_bpe.decode_pieces([i] for i in ids)) == "\U0001f642é"
    assert byte_bpe.round_trip(edges.limit(0), "doc_id").count() == 0


# 9 quality


def test_quality_counts(spark, texts):
    rows = {r.doc_id: r for r in RUN["op9_quality_rules"](spark, SMALL).collect()}
    for d, t in texts.items():
        w = words(t)
        seen = Counter(zip(w, w[1:], w[2:]))
        again = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        lines = [x for x in t.split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        wanted = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), failed)
        r = rows[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == wanted
        assert not (r.base_failed and r.kept)


def test_quality_sketches_merge_and_bound(spark):
    rows = [(i, "en", f"s{i % 3}", " ".join(f"w{i}x{j}" for j in range(60 + i % 7))) for i in range(300)]
    rows += [(900, "en", "s0", " ".join(f"a{j} ###" for j in range(60))), (901, None, None, rows[0][3])]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    measured = staged(quality.measure(docs), "measured")
    fine = quality.sketches(measured, ["lang", "source"])
    whole = {(r.lang, r.metric, r.bucket): r.n for r in quality.sketches(measured, ["lang"]).collect()}
    assert whole == {(r.lang, r.metric, r.bucket): r.n for r in quality.merged(fine, ["lang"]).collect()}
    judged = {r.doc_id: r for r in quality.judge(measured).collect()}
    assert len(judged) == len(rows) and judged[900].broken == ["symbols"] and judged[901].kept
    assert sum(r.kept for r in judged.values()) == 301


def test_quality_verdict_depends_on_source(spark):
    def text(i, symbols):
        return " ".join(f"w{i:03}x{j:02}" + "#" * (j < symbols) for j in range(60))

    rows = [(i, "en", "plain", text(i, 0)) for i in range(200)] + [(200 + i, "en", "code", text(i, 3 + i % 4)) for i in range(200)]
    rows += [(900, "en", "plain", text(900, 5)), (901, "en", "code", text(900, 5))]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    judged = {r.doc_id: r for r in quality.judge(staged(quality.measure(docs), "measured")).collect()}
    assert judged[900].broken == ["symbols"] and judged[901].kept
    assert sum(r.kept for r in judged.values()) == 401


def test_quality_edges(spark, edges):
    judged = quality.judge(staged(quality.measure(edges), "measured"))
    assert judged.count() == len(EDGES) and judged.where("kept").count() == 0
    assert quality.judge(staged(quality.measure(edges.limit(0)), "measured")).count() == 0


# 10 decontamination


def test_suffix_array_is_sorted():
    draw = random.Random(6)
    for _ in range(60):
        ids = np.array([draw.choice([0, 1, 1, 2, 3]) for _ in range(draw.randint(0, 80))], np.int64)
        packed = decontaminate.Packed(ids, 20)

        def text(i):
            return tuple(ids[i:].tolist()[: (ids[i:].tolist() + [0]).index(0)])

        order = decontaminate.suffix_array(packed).tolist()
        assert sorted(order) == np.flatnonzero(ids).tolist()
        assert [text(i) for i in order] == sorted(text(i) for i in order)


@pytest.mark.parametrize("shard, block", [(60, 200), (1 << 20, 1 << 20)])
def test_matches_are_exact(spark, monkeypatch, shard, block):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    draw = random.Random(7)
    docs = [" ".join(draw.choice("abc") for _ in range(draw.randint(0, 40))) for _ in range(40)] + [None, ""]
    items = [(i, " ".join(draw.choice("abc") for _ in range(draw.randint(0, 9)))) for i in range(12)] + [(50, None)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    for r in decontaminate.find_matches(df, tests, width=6).collect():
        w, hit, named = words(r.text), set(), set()
        for i, t in items:
            x = words(t)
            n = min(6, len(x))
            for j in range(len(x) - n + 1 if x else 0):
                for k in range(len(w) - n + 1):
                    if w[k : k + n] == x[j : j + n]:
                        named.add(str(i))
                        hit |= set(range(k, k + n))
        assert (r.n_words, r.n_hit, r.items) == (len(w), len(hit), sorted(named))
        for m in r.matches:
            x = words(dict(items)[int(m.item)])
            assert w[m.start : m.start + m.length] == x[m.item_start : m.item_start + m.length]


def test_decontamination_edges(spark, edges):
    tests = spark.createDataFrame([(1, "A b, c D"), (2, None), (3, "!!")], "item_id long, text string")
    found = decontaminate.find_matches(edges, tests)
    assert found.count() == len(EDGES) and {r.doc_id for r in found.where("n_hit > 0").collect()} == {5}
    assert decontaminate.clean(edges, tests).count() == len(EDGES) - 2
    assert decontaminate.clean(edges, tests).columns == edges.columns
    assert decontaminate.find_matches(edges.limit(0), tests.limit(0)).count() == 0


# 11 spelling variants


def brute_variants(counts, letters=6, least=5, ratio=5):
    kept = {w: n for w, n in counts.items() if len(w) >= letters and n >= least}
    without, near = defaultdict(set), defaultdict(set)
    for w in kept:
        for i in range(len(w)):
            without[w[:i] + w[i + 1 :]].add((w, i))
    for short, found in without.items():
        for w, i in found:
            if short in kept:
                near[w].add(short)
                near[short].add(w)
            near[w] |= {x for x, j in found if i == j and x != w}
    form = {}
    for w, n in kept.items():
        best = min(near[w], key=lambda x: (-kept[x], x), default=None)
        form[w] = best if best is not None and kept[best] >= ratio * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), kept.get(form[w])) for w, n in kept.items()}


def planted_counts(texts):
    counts = Counter()
    for d, text in texts.items():
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text):
            w = lower(run)
            h = zlib.crc32(f"{d}:{w}".encode())
            counts[w if h % 199 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    return counts


def test_spelling_whole_table(spark, texts):
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in RUN["op11_spelling_variants"](spark, SMALL).collect()}
    wanted = brute_variants(planted_counts(texts))
    assert got == wanted and any(r != w for w, _, r, *_ in wanted)


@pytest.mark.parametrize("bucket", [40, 40_000])
def test_near_words_in_blocks(spark, monkeypatch, bucket):
    """Words of few letters and many lengths, with whole halves in common, in one block and in many."""
    monkeypatch.setattr(spelling, "BUCKET_LETTERS", bucket)
    draw = random.Random(11)
    words = {"".join(draw.choices("ab\u00e9", k=draw.randint(1, 8))) for _ in range(250)} | {"a" * 3000, "a" * 3001, "b" + "a" * 2999}
    counts = {w: draw.choice([1, 6, 31, 160]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {tuple(r) for r in spelling.variants(df, letters=1, least=1).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == brute_variants(counts, 1, 1)


def test_spelling_edges(spark, edges):
    counts = {r.word: r.n for r in spelling.word_counts(edges).collect()}
    assert counts["word"] == 20_000 and counts["endoftext"] == 1 and None not in counts
    assert counts["no"] == counts["at"] == 1 and "\u00fcn\u00ef" not in counts and "\u00dcn\u00ef" in counts
    none = spelling.variants(spelling.word_counts(edges.limit(0)))
    assert none.count() == 0 and none.columns == ["word", "form", "root", "n", "n_near", "form_n"]


# 12 n-gram Jaccard join


def gram_set(text, width):
    w = words(lower(text))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute_groups(sets, percent):
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_jaccard_joins_all_that_are_similar(spark, monkeypatch, width, percent):
    """Near copies of many degrees around two texts, copies, short texts, and a passage that all share."""
    monkeypatch.setattr(jaccard, "PART_BYTES", 20_000)
    draw = random.Random(12)
    passage, rows = [f"p{i}" for i in range(30)], []
    for base in range(2):
        text = [f"b{base}-{draw.randint(0, 60)}" for _ in range(150)]
        for _ in range(60):
            copy = list(text)
            for _ in range(draw.randint(0, 9)):
                copy[draw.randrange(len(copy))] = f"x{draw.randint(0, 40)}"
            rows.append(copy)
    rows += [passage + [f"own{i}-{k}" for k in range(draw.randint(0, 30))] for i in range(40)]
    rows += [["a", "b"], ["a", "b"], ["a"], ["A", "b", "c"], [], [f"s{i}" for i in range(11)], [f"s{i}" for i in range(12)]]
    draw.shuffle(rows)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs, width=width, percent=percent).collect()}
    wanted = brute_groups({i: gram_set(" ".join(w), width) for i, w in enumerate(rows)}, percent)
    assert got == wanted and len({c for _, c in wanted.values()}) < len(rows) - 20


def test_jaccard_edges(spark, edges):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_groups(edges).collect()), key=str)
    wanted = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 4, 5), (5, 4, 5), (6, 1, 6), (7, 1, 7), (None, 1, None)]
    assert got == sorted(wanted, key=str)
    assert jaccard.similar_groups(edges.limit(0)).count() == 0


def test_counts_of_a_bucket_take_little_memory():
    draw, rows = np.random.default_rng(12), []
    for part in range(4):
        rests = np.unique(draw.integers(0, 1 << 20, 150_000)).astype(np.uint32)
        several = np.flatnonzero(draw.random(len(rests)) < 0.1).astype(np.uint32)
        extra = draw.integers(2, 50, len(several)).astype(np.uint32)
        rows.append((part, 7, rests.tobytes(), several.tobytes(), extra.tobytes()))
    names = ["part", "bucket", "rests", "several", "extra"]
    table = pa.concat_tables(pa.table([pa.array(c) for c in zip(*some)], names) for some in (rows[:1], rows[1:]))
    sums, total = Counter(), 0
    for _, _, rests, several, extra in rows:
        n = np.ones(len(rests) // 4, np.int64)
        n[np.frombuffer(several, np.uint32)] = np.frombuffer(extra, np.uint32)
        total += len(n)
        for rest, k in zip(np.frombuffer(rests, np.uint32).tolist(), n.tolist()):
            sums[rest] += k
    found = []
    assert peak(lambda: found.append(jaccard._count(table))) < 24 * total
    got = [(r["part"], r["bucket"], r["classes"]) for r in found[0].to_pylist()]
    assert got == [
        (p, b, bytes(sums[x].bit_length() - 1 for x in np.frombuffer(rests, np.uint32).tolist())) for p, b, rests, *_ in rows
    ]


def test_ngrams_of_a_part_take_little_memory():
    draw = random.Random(12)
    texts = [" ".join("%x" % draw.getrandbits(32) for _ in range(1000)) for _ in range(200)]
    batch = pa.RecordBatch.from_pydict({"part": [0], "texts": [texts]})
    assert peak(lambda: list(jaccard._send(3, 90, 8)([batch]))) < 16 * sum(map(len, texts))


# 13 ranked search


def brute_ranks(docs, items, k):
    pattern = re.compile(ranked.TERM_PATTERN)
    docs = [(d, Counter(pattern.findall(lower(t)))) for d, t in docs]
    n, total = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in docs:
            m = 10 + 90 * sum(c.values()) * n // total if total else 0
            each = (
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(pattern.findall(lower(text)))
                if c[t]
            )
            scores.append((-sum(each), d is None, d))
        best = sorted(s for s in scores if s[0] < 0)[:k]
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize(("part", "block", "taken"), [(3_000, 500, 2), (8 << 20, 4 << 20, 64)])
def test_ranks_are_exact(spark, monkeypatch, texts, part, block, taken):
    for name, value in (("PART_BYTES", part), ("BLOCK_BYTES", block), ("TAKEN", taken)):
        monkeypatch.setattr(ranked, name, value)
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3)
    got = sorted(tuple(r) for r in ranked.search(docs, items, k=7).select("item_id", "rank", "doc_id", "score").collect())
    assert got == brute_ranks(texts.items(), [(r.item_id, r.text) for r in items.collect()], 7)


def test_search_takes_little_more_than_the_index():
    draw = np.random.default_rng(13)
    cells = np.unique(draw.integers(0, 60_000 * 2_000, 300_000))
    rows, columns = cells // 2_000, cells % 2_000
    values = draw.integers(1, 1 << 20, len(cells))
    nodes = ranked.treap(rows, columns, values, ranked.height_of(60_000, 2_000))
    terms = [b"term%d" % i for i in range(60_000)]
    lists = [pa.array([x], pa.list_(k)) for x, k in ((list(range(2_000)), pa.int64()), (terms, pa.binary()), ([1] * 60_000, pa.int32()))]
    arrays = [*lists, *(pa.array([x.tobytes()], pa.binary()) for x in nodes)]
    batch = pa.RecordBatch.from_arrays(arrays, ["ids", *ranked.PARTS])
    asked, kind, found = [5, 7, 59_999], pa.schema([("item", pa.int64()), ("key", pa.int64()), ("score", pa.int64())]), []
    block = [(1, [b"none", *(terms[i] for i in asked)], [9, 2, 3, 4])]
    size, search = batch.nbytes, ranked._search(block, 3, kind)
    assert peak(lambda: found.extend(search(iter([batch])))) < 2 * size
    scores = Counter()
    for i, weight in zip(asked, (2, 3, 4)):
        here = rows == i
        for c, v in zip(columns[here].tolist(), values[here].tolist()):
            scores[c] += weight * v
    best = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:3]
    assert [(r["key"], r["score"]) for b in found for r in b.to_pylist()] == best


def test_treap_holds_all_cells():
    draw = random.Random(13)
    cells = {(draw.randrange(40), draw.randrange(9)): draw.randint(1, 99) for _ in range(150)}
    rows, columns = (np.array(x, np.int64) for x in zip(*cells))
    values = np.array(list(cells.values()), np.int64)
    height = ranked.height_of(40, 9)
    nodes = ranked.treap(rows, columns, values, height)
    assert len(nodes[0]) < 3 * len(cells)
    row = dict(zip(ranked.PARTS[2:], (x.tobytes() for x in nodes)))
    index = ranked._Index({"terms": [b"%d" % i for i in range(40)], "ids": list(range(9)), **row})
    for r in range(40):
        scores, found = index.best([b"%d" % r], [3], 9, 0)
        assert dict(zip(found.tolist(), scores.tolist())) == {c: 3 * v for (x, c), v in cells.items() if x == r}


def test_search_edges(spark, edges):
    items = spark.createDataFrame([(1, "One word, all!"), (2, None), (3, "..."), (4, "nowhere"), (5, "a b")], "item_id int, text string")
    got = sorted(tuple(r) for r in ranked.search(edges, items).select("item_id", "rank", "doc_id", "score").collect())
    docs = [(r.doc_id, r.text or "") for r in edges.collect()]
    assert got == brute_ranks(docs, [(r.item_id, r.text or "") for r in items.collect()], 10)
    assert {r[0] for r in got} == {1, 5} and [r[2] for r in got if r[0] == 5] == [5, 5]
    assert ranked.search(edges.limit(0), items).count() == ranked.search(edges, items.limit(0)).count() == 0


# pipeline


def test_pipeline_stages(spark, reference):
    docs = staged(spark.read.parquet(f"{SMALL}/documents.parquet"), "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text or "" for r in docs.collect()}
        docs = staged(stage(spark, docs, SMALL), name)
        after = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and set(after) <= set(before)
        if name == "near_dedup":
            found = brute_components({d: simhash.fingerprint(t, 4) for d, t in before.items()}, 4)
            assert set(after) == set(found.values()) and all(before[d] == after[d] for d in after)
        if name == "substring_dedup":
            wanted = dict(zip(before, brute_cut(before.values(), 35)))
            assert all(words(after[d]) == wanted[d][2].split(" ") if wanted[d][2] else d not in after for d in after)
            assert set(after) == {d for d in before if wanted[d][2] or not wanted[d][1]}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id: r.n_tokens for r in last} == {d: len(reference.encode_ordinary(t)) for d, t in after.items()}
    assert all(r.same for r in last) and names[1] == "near_dedup"
