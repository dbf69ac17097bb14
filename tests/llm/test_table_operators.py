"""Mixing, sharding, chat formatting, line dedup, quality, top-k: against brute force."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASHING, docs_frame, edge_rows, words


def _targets(sizes):
    """Targets by the definition: share by weight, cap at 3 times, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {s for s in names if not sizes[s]}
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and weight[s] * rest / free >= 3 * sizes[s]} if free else set()
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else weight[s] * rest / free for s in names}
        capped |= over


def _many(seed, n=3000):
    r = random.Random(seed)
    return [(i, " ".join("x" * r.randint(1, 3) for _ in range(r.randint(0, 40))) + f" {i}", r.choice(["hot"] * 4 + ["a", "b", "c", None, "", "tiny"][: 1 + i % 6]))
            for i in range(n)]


@pytest.mark.parametrize("rows", [edge_rows(), _many(1), []], ids=["edge", "many", "empty"])
def test_mixing(spark, rows):
    from ledgerlens.llm.mixing import mix_sources, mixed
    frame = docs_frame(spark, rows, clashing=True)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    want, got = _targets(sizes) if rows else {}, mixed(frame).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.mix.size == len(words(r.text)) and r.mix.source_size == sizes[r.source]
        assert r.mix.target == pytest.approx(want[r.source]) and 0 <= r.mix.copies <= 3
        rate = r.mix.target / r.mix.source_size if r.mix.source_size else 0
        assert int(rate) <= r.mix.copies <= int(rate) + 1 and r.rate == "own rate"
        taken[r.source] += r.mix.size * r.mix.copies
    if len(rows) > 1000:
        for s in sizes:
            assert taken[s] == pytest.approx(want[s], rel=0.2)
    out = mix_sources(frame)
    assert out.columns == frame.columns
    assert Counter(map(str, out.collect())) == Counter(map(str, mix_sources(frame.repartition(5)).collect()))
    assert out.count() == sum(r.mix.copies for r in got)


def test_mixing_with_salted_lookup(spark, monkeypatch):
    from ledgerlens.llm import common, mixing
    frame = docs_frame(spark, _many(2, 500))
    plain = Counter(map(str, mixing.mixed(frame).collect()))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 1)
    assert Counter(map(str, mixing.mixed(frame).collect())) == plain


def test_repeated_rows_draw_on_their_own(spark):
    """A thousand rows alike come near their source's target; reruns and other partitionings agree."""
    from ledgerlens.llm.mixing import mixed
    rows = [(1, "a b c", "a")] * 1000 + [(None, "x y", "b")] * 700 + [(1, "a b c", "c")] * 300 + [(k, "u v w", "c") for k in range(2, 400)] + [(5, None, "b"), (5, "", "b")]
    frame = docs_frame(spark, rows, clashing=True).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    want, got = _targets(sizes), mixed(frame.repartition(3))
    taken = Counter()
    for r in got.collect():
        taken[r.source] += r.mix.size * r.mix.copies
    assert got.count() == len(rows) and got.columns == [*[c for c in frame.columns if c != "mix"], "mix"]
    for s in sizes:
        assert taken[s] == pytest.approx(want[s], rel=0.08)
    assert Counter(map(str, got.collect())) == Counter(map(str, mixed(frame.repartition(8)).collect()))


@pytest.mark.parametrize("limit", [1, 60, 300, 5000, 10 ** 9])
@pytest.mark.parametrize("rows", [edge_rows(), _many(3, 400) + [(1, "same text", "a")] * 200, []], ids=["edge", "many", "empty"])
def test_sharding(spark, rows, limit):
    from ledgerlens.llm.sharding import HASH_BITS, assign_shards
    frame = docs_frame(spark, rows, clashing=True)
    got = assign_shards(frame, limit).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(map(key, got)) == sorted(map(key, rows))
    if got:
        assert got[0].key == "own key"
    held, size = defaultdict(list), {}
    for r in got:
        h = int(hashlib.md5(f"{'' if r.doc_id is None else r.doc_id}|{r.text or ''}".encode()).hexdigest()[:15], 16)
        bits = format(h, f"0{HASH_BITS}b")
        name = r.shard.split("+")[0]
        assert name == "root" or bits.startswith(name)
        assert r.doc_bytes == len((r.text or "").encode())
        held[r.shard].append(r.doc_bytes)
        size[r.shard] = r.shard_bytes
    for s, b in held.items():
        assert sum(b) == size[s] and (sum(b) <= limit or len(b) == 1)
    # only oversized buckets are split: the parent of every leaf is over the limit
    for s in {s.split("+")[0] for s in held} - {"root"}:
        inside = [b for t, bs in held.items() for b in bs if t.split("+")[0].startswith(s[:-1])]
        assert sum(inside) > limit and len(inside) > 1


def _conversations():
    r = random.Random(0)
    marks = ["\\", "<|", "|>", "<|turn|>", "<|end|>", "<", "\n", "\\n", "a", "é", "\U0001F600", "", "$1", "\\\\<|", "assistant"]
    rows = [(c, t, r.choice(["user", "assistant", "system", None, "as\nsist", "<|end|>\\"]), None if r.random() < 0.1 else "".join(r.choice(marks) for _ in range(r.randint(0, 8))))
            for c in [1, 2, 3, None, 9] for t in [*range(6), None, 2]]
    return rows + [(7, 0, "assistant", "x"), (7, 0, "assistant", "x"), (8, 1, "user", "only"), (10, None, None, None)] + [
        (11, k, "user" if k % 2 else "assistant", "t" * 50 + str(k)) for k in range(500)]


def test_chat_round_trip(spark):
    from ledgerlens.llm.chat_format import digests, examples, formatted, materialised, read_back, unescape
    rows = _conversations()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("own"))
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda x: (x[1] is None, x[1] or 0, (x[2] or "").encode(), (x[3] or "").encode())):
        want[c].append((role or "", text or ""))
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in read_back(formatted(frame)).collect()}
    assert back == dict(want)
    for r in digests(frame).collect():
        turns = want[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    full = materialised(frame).withColumn("said", unescape(F.expr("substring(text, cast(loss_start as int) + 1, cast(loss_end - loss_start as int))"))).collect()
    whole = {r.conv_id: r.formatted for r in formatted(frame).collect()}
    said = defaultdict(list)
    for r in sorted(full, key=lambda r: r.example_no):
        assert whole[r.conv_id].startswith(r.text) and len(r.text) == r.loss_end
        said[r.conv_id].append(r.said)
    assert dict(said) == {c: x for c, t in want.items() if (x := [b for a, b in t if a == "assistant"])}
    assert examples(frame).count() == len(full) and digests(frame.limit(0)).count() == 0


def test_chat_digests_read_the_loss_mask(spark, monkeypatch):
    """The replies come out of the formatted text under the mask, so a wrong mask changes the result; also far into long texts."""
    from ledgerlens.llm import chat_format as C
    rows = _conversations() + [(12, k, "assistant" if k % 3 else "user", "😀<|\\" * (300 * k) + "é") for k in range(6)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    loss = defaultdict(str)
    for c, _, role, text in sorted(rows, key=lambda x: (x[1] is None, x[1] or 0, (x[2] or "").encode(), (x[3] or "").encode())):
        loss[c] += (text or "") * (role == "assistant")
    want = {c: (len(x), hashlib.sha256(x.encode()).hexdigest()) for c, x in loss.items()}
    told = lambda: {r.conv_id: (r.loss_chars, r.loss_sha256) for r in C.digests(frame).collect()}
    assert told() == want
    right = C.examples
    monkeypatch.setattr(C, "examples", lambda *a: right(*a).withColumn("context_chars", F.col("context_chars") - 1))
    wrong = told()
    assert all(wrong[c] != want[c] for c in want if loss[c])


def test_line_dedup(spark):
    from ledgerlens.llm.line_dedup import drop_boilerplate
    pages = [(k, "http://Hot.example:80/a?b", f"<p>Menu</p><div>own {k}</div><script>var a='<p>Menu</p>'</script><!-- Menu --><br>Menu<b>!</b>"
              + ("<li>half</li>" if k < 10 else "")) for k in range(20)]
    pages += [(50 + k, "https://user@small.example/x", "<p>Menu</p>\n<p>Menu</p>") for k in range(4)]
    pages += [(60, None, "<p>Menu</p>"), (61, "no url", "Menu"), (62, "http://hot.example", None), (None, "http://hot.example", "<p> Menu </p>\n\n"), (0, *pages[0][1:])]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    for c in CLASHING + ["host", "lines", "bad", "site"]:
        frame = frame.withColumn(c, F.lit("own"))
    got = drop_boilerplate(frame, 0.5, 5).collect()
    assert len(got) == len(pages)
    for r in got:
        if r.host == "hot.example":
            assert r.host_pages == 23 and "Menu" not in r.kept_text.split("\n")
            if r.page_id is not None and r.page_id < 20:
                want = [f"own {r.page_id}", "Menu!"] + ["half"] * (r.page_id < 10)
                assert r.n_lines == len(want) + 1
                assert r.kept_text.split("\n") == [x for x in want if x != "Menu!"]  # on nearly all pages too
        elif r.host == "small.example":
            assert r.n_dropped == 0 and r.kept_text == "Menu\nMenu" and r.host_pages == 4
        else:
            assert r.host == "" and r.n_dropped == 0 and r.host_pages == 0
    assert drop_boilerplate(frame.limit(0)).count() == 0


def test_small_hosts_lose_their_footer(spark):
    """The ratio alone decides: a footer on all three pages goes, a line on one page of one never does."""
    from ledgerlens.llm.line_dedup import drop_boilerplate
    pages = [(k, "http://three.example/", f"<p>own {k}</p><div>footer</div>") for k in range(3)] + [(9, "http://one.example/", "<p>x</p><p>x</p>")]
    got = {r.page_id: (r.kept_text, r.n_dropped) for r in drop_boilerplate(spark.createDataFrame(pages, "page_id long, url string, html string"), 0.2).collect()}
    assert got == {0: ("own 0", 1), 1: ("own 1", 1), 2: ("own 2", 1), 9: ("x\nx", 0)}


def test_lines_of_odd_pages_by_plain_regular_expressions(spark):
    """Cutting before the last end gives what replacing in the whole text gives."""
    from ledgerlens.llm.line_dedup import PARTS, page_lines
    r = random.Random(6)
    bits = ["<script a>", "</script >", "<STYLE>", "</style>", "<!--", "-->", "<p>", "</DIV x='1'>", "<b", "<", ">", "text ", "\n", "é", "<br/>", "<bravo>"]
    pages = ["".join(r.choice(bits) for _ in range(r.randrange(1, 25))) for _ in range(400)]
    got = [row.x for row in spark.createDataFrame([(k, p) for k, p in enumerate(pages)], "k long, html string").select("k", page_lines(F.col("html")).alias("x")).orderBy("k").collect()]
    for page, lines in zip(pages, got, strict=True):
        for part, by, _ in PARTS:
            page = re.sub(part, by, page)
        assert lines == [x for x in (y.strip(" ") for y in re.split(r"[\n\r]", page)) if x]


@pytest.mark.parametrize("bit", ["<", "<!--", "<script ", "<p ", "<style>-->", "</script"])
def test_long_pages_take_linear_time(spark, bit):
    from ledgerlens.llm.line_dedup import drop_boilerplate
    page = (bit * (1_000_000 // len(bit) + 1))[:1_000_000]
    frame = spark.createDataFrame([(1, "http://a.example/", page + ">" + page)], "page_id long, url string, html string")
    start = time.time()
    assert drop_boilerplate(frame).count() == 1
    assert time.time() - start < 20


def test_quality_accuracy_and_rules(spark):
    from ledgerlens.llm.quality import keep_good, scored
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = scored(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    assert ((got.score >= 0.5) == got.predicted.astype(bool)).all() and got.score.between(0, 1).all()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.99 and (held[held.quality == 1].predicted == 1).mean() > 0.99
    # labels of held-out rows teach nothing
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = scored(docs, turned).toPandas().set_index("doc_id").score
    assert np.allclose(again[got.doc_id].to_numpy(), got.score.to_numpy())
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and 0.7 * docs.count() < kept.count() < docs.count()


def test_quality_edge_cases(spark):
    from ledgerlens.llm.quality import keep_good, scored
    rows = edge_rows()
    frame = docs_frame(spark, rows, clashing=True).withColumn("quality", F.lit(0)).withColumn("y", F.lit(1))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in scored(frame, none).collect()] == [0.5] * len(rows)
    assert keep_good(frame, none).count() == len(rows) and keep_good(frame, none).columns == frame.columns
    few = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 14)] + [(1, None, 0), (None, 1, 0), (2, 0, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    out = scored(frame, few).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert scored(frame.limit(0), few).count() == 0


def _brute(vectors, k, every=20, scale=64):
    fine = []
    for i, v in vectors:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(scale * float(x))) for x in v]
        fine.append((i, q))
    out = {}
    for i, q in fine:
        if i % every:
            continue
        best = out.setdefault(i, {})
        for j, c in fine:
            if j != i:
                s = sum(a * b for a, b in zip(q, c))
                best[j] = max(best.get(j, s), s)
    return sorted((i, n + 1, j, s) for i, b in out.items() for n, (j, s) in enumerate(sorted(b.items(), key=lambda x: (-x[1], x[0]))[:k]))


@pytest.mark.parametrize("kind", ["clusters", "copies", "spread", "odd", "few", "empty"])
def test_top_k(spark, kind):
    from ledgerlens.llm.topk import top_k
    r = np.random.default_rng(7)
    centers = r.normal(size=(6, 8))
    rows = {"clusters": [(i, (centers[i % 6] + 0.1 * r.normal(size=8)).tolist()) for i in range(600)],
            "copies": [(i, [0.5, 0.25] if i % 3 else r.normal(size=2).tolist()) for i in range(400)],
            "spread": [(i, r.normal(size=3).tolist()) for i in range(500)],
            "odd": [(0, [1.0, 2.0]), (20, None), (40, [float("nan"), 1.0]), (60, [float("inf"), 0.0]), (1, [None, 1.0]), (2, []), (3, [0.5]), (4, [1.0, 2.0, 3.0]),
                    (None, [1.0]), (0, [1.0, 2.0]), (0, [3.0, -1.0]), (80, []), (5, [1e9, 1e9]), (100, [1e9, -1e9])],
            "few": [(20, [1.0]), (40, [1.0]), (41, [1.0])], "empty": []}[kind]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit("own")).withColumn("score", F.lit(1))
    for block, query_block in ((8192, 2048), (100, 7)):
        got = sorted((x.query_id, x.rank, x.vec_id, x.score) for x in top_k(frame, 5, block=block, query_block=query_block).collect())
        assert got == _brute(rows, 5)


def test_queries_go_only_to_cells_within_reach(spark):
    """Clustered vectors: most (query, cell) pairs are left out, and the rows stay exact."""
    from ledgerlens.llm import topk as T
    r = np.random.default_rng(3)
    middle = r.normal(size=(40, 64))
    rows = [(i, (middle[i % 40] + 0.05 * r.normal(size=64)).tolist()) for i in range(8000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    stored_rows = T._vectors(frame, 64, "vec_id", "embedding")
    _, _, queries, cells = T.search_plan(stored_rows, 20, 20, 1000, 200)
    assert cells.rows.sum() == 8000 and 32 <= len(cells.rows) <= 120
    scored = sum(cells.rows[q.home] + sum(cells.rows[q.reached]) for q in queries.collect())
    print("share of pairs in cells within reach:", scored / (8000 * 400))
    assert scored < 0.3 * 8000 * 400
    x = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64)
    want = []
    for q in range(0, 8000, 20):
        p = x @ x[q]
        p[q] = -(1 << 62)
        want += [(q, n + 1, int(j), int(p[j])) for n, j in enumerate(np.lexsort((np.arange(8000), -p))[:20])]
    got = sorted(tuple(z) for z in T.top_k(frame, block=1000, query_block=200).collect())
    assert got == sorted(want)


@pytest.mark.parametrize("size", [1.0, 1e4, 3e8])
def test_cell_bounds_hold(spark, size):
    """No row of a cell scores over its bound, near cancellation and at large components as well."""
    from ledgerlens.llm import topk as T
    r = np.random.default_rng(4)
    rows = [(i, (size * r.normal(size=5)).tolist()) for i in range(500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(z) for z in T.top_k(frame, 5, block=40, query_block=10, scale=1).collect())
    assert got == _brute(rows, 5, scale=1)


def test_cover_tree_invariants():
    from ledgerlens.llm.topk import CoverTree
    p = np.random.default_rng(1).normal(size=(900, 5))
    t = CoverTree(p, leaf=10)
    assert sorted(t.order.tolist()) == list(range(900))
    for n in range(len(t.center)):
        mine = t.order[t.lo[n]:t.hi[n]]
        assert t.center[n] in mine and np.sqrt(((p[mine] - p[t.center[n]]) ** 2).sum(axis=1)).max() <= t.radius[n] + 1e-9
        if t.children[n]:
            assert sorted(x for c in t.children[n] for x in t.order[t.lo[c]:t.hi[c]]) == sorted(mine)


def test_cover_tree_levels_cover_or_reach_the_fan_out():
    """Below FAN children all points lie within the level's radius; no node has more than FAN."""
    from ledgerlens.llm.topk import FAN, SHRINK, CoverTree
    for width in (1, 2, 30):
        p = np.random.default_rng(2).normal(size=(1500, width))
        t = CoverTree(p, leaf=10)
        sizes = [len(c) for c in t.children if c]
        assert max(sizes) <= FAN and min(sizes) >= 2
        for n, below in enumerate(t.children):
            if 2 < len(below) < FAN:
                assert max(t.radius[c] for c in below) <= SHRINK * t.radius[n] + 1e-9
    assert max(sizes) == FAN  # in 30 dimensions levels reach it
