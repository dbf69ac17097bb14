"""Substring dedup, SimHash, decontamination, token counts: against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import components, docs_frame, edge_rows, leaks, simhash, windows_removed, words


def _planted(seed, n=60):
    """Random texts over few words, with shared passages inside."""
    r = random.Random(seed)
    passages = [" ".join(r.choice("abcdefgh") + str(r.randint(0, 9)) for _ in range(r.randint(13, 70))) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [" ".join(r.choice("klmnop") + str(r.randint(0, 99)) for _ in range(r.randint(0, 60))) for _ in range(3)]
        if r.random() < 0.6:
            parts.insert(r.randint(0, 3), r.choice(passages))
        rows.append((r.randint(0, 200), r.choice([" ", "\n", "\t  "]).join(parts), r.choice("abc")))
    return rows


@pytest.mark.parametrize("rows", [edge_rows(), _planted(1), _planted(2), []], ids=["edge", "planted1", "planted2", "empty"])
def test_substring_dedup(spark, rows):
    from ledgerlens.llm.substring_dedup import remove_repeated_windows
    got = remove_repeated_windows(docs_frame(spark, rows, clashing=True)).collect()
    mine = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str)
    assert mine == sorted(windows_removed(rows), key=str)
    for r in got:  # intervals are maximal and apart, and cover what was removed
        spans = [(s.start, s.end) for s in r.removed]
        assert sum(e - s for s, e in spans) == r.n_removed and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_substring_dedup_over_many_batches(spark, monkeypatch):
    from ledgerlens.llm import substring_dedup as S
    rows = [(i, " ".join(f"p{k}" for k in range(30)) + f" own{i} " + " ".join(f"{i}_{k}" for k in range(20)), "a") for i in range(300)]
    got = S.remove_repeated_windows(docs_frame(spark, rows).repartition(7)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(i, 30 if i else 0) for i in range(300)]


def test_substring_dedup_of_colliding_windows(spark):
    """Thue-Morse words: every polynomial hash modulo 2^64 takes the two for one word, so all 64 bits of their windows agree."""
    from ledgerlens.llm import substring_dedup as S
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << 12))
    two = "".join("ba"[bin(i).count("1") % 2] for i in range(1 << 12))
    buf = np.frombuffer(f"{one} {two}".encode(), np.uint8)
    a, b = S.Hasher().words(buf, np.array([0, 4097]), np.array([4096, 8193]))
    assert a == b and one != two
    shared = " ".join(f"s{k}" for k in range(12))
    rows = [(i, f"{shared} {w} own{i}", "a") for i, w in ((1, one), (2, two), (3, one), (4, two), (5, "z"), (None, two))]
    for parts in (1, 6):
        got = S.remove_repeated_windows(docs_frame(spark, rows).repartition(parts)).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == sorted(windows_removed(rows), key=str)
    assert {r.doc_id: r.n_removed for r in got} == {1: 0, 2: 0, 3: 13, 4: 13, 5: 0, None: 13}


def test_substring_dedup_of_rows_repeated_across_batches(spark):
    """A repeated row stands beside its copy's match in one partition and alone in another."""
    from ledgerlens.llm.substring_dedup import remove_repeated_windows
    text = " ".join(f"p{k}" for k in range(20))
    for order in ([(5, text, "a"), (7, text, "a"), (5, text, "a"), (6, "x", "a")], [(5, text, "a"), (6, "x", "a"), (5, text, "a"), (7, text, "a")]):
        frame = docs_frame(spark, order[:2]).coalesce(1).union(docs_frame(spark, order[2:]).coalesce(1))
        got = remove_repeated_windows(frame).collect()
        assert sorted((r.doc_id, r.n_removed) for r in got) == [(5, 0), (5, 0), (6, 0), (7, 20)]


def test_substring_dedup_of_arrays_longer_than_a_bitmap(spark):
    """Two million windows in 64 buckets: a bucket's array has more positions than one bitmap covers."""
    from ledgerlens.llm import substring_dedup as S
    n = 66 * S.BITMAP
    text = " ".join(f"{i:x}" for i in range(n))
    frame = docs_frame(spark, [(1, text, "a")]).union(docs_frame(spark, [(2, f"own {text}", "a")])).union(docs_frame(spark, [(3, "own words", "a")]))
    got = S.remove_repeated_windows(frame).select("doc_id", "n_words", "n_removed").collect()
    assert sorted(map(tuple, got)) == [(1, n, 0), (2, n + 1, n), (3, 2, 0)]


def test_substring_dedup_counts_in_one_shuffle_by_bucket(spark):
    from ledgerlens.llm import substring_dedup as S
    for sure, arrays in ((False, "h array<int>"), (True, "h array<bigint>, g array<bigint>, d array<bigint>")):
        blocks = spark.createDataFrame([], f"bucket int, batch long, {arrays}")
        plan = S._counted(blocks, sure, 6)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        assert plan.count("Exchange") == 1 and "Window" in plan and "Pandas" not in plan, plan


def test_packing_round_trip():
    from ledgerlens.llm.substring_dedup import _gather, _pack, _spread, _unpack
    for v in ([0], [5, 5, 6, 1000, 1 << 33], list(range(0, 3000, 7)), [], [255], [254, 509]):
        assert _unpack(_pack(np.array(v, np.int64))).tolist() == v
    for v in ([-5, 0, 9], [np.iinfo(np.int64).min, 0, np.iinfo(np.int64).max], [np.iinfo(np.int64).max] * 2, [7]):
        assert _gather(_spread(np.array(v, np.int64))).tolist() == v


def _near_rows(seed):
    """Groups of exact and near copies of all sizes, and loners."""
    r = random.Random(seed)
    rows = []
    for g in range(25):
        text = [f"g{g}t{r.randint(0, 500)}" for _ in range(r.randint(1, 400))]
        for _ in range(r.choice([1, 1, 2, 5, 12])):
            own = list(text)
            for _ in range(r.randint(0, 2)):
                own[r.randrange(len(own))] = f"new{r.randint(0, 9)}"
            rows.append((len(rows) * 3 + 1, " ".join(own).title() if r.random() < 0.3 else " ".join(own), "a"))
    r.shuffle(rows)
    return rows


def _expected(rows):
    fps = [simhash(t) for _, t, _ in rows]
    group = components(set(fps), lambda a, b: bin(a ^ b).count("1") <= 3)
    by_fp = {}
    for (i, _, _), f in zip(rows, fps):
        by_fp.setdefault(f, []).append(i)
    least = {f: min((i for g in group[f] for i in by_fp[g] if i is not None), default=None) for f in group}
    return sorted(((i, f, least[f]) for (i, _, _), f in zip(rows, fps)), key=str)


@pytest.mark.parametrize("rows", [edge_rows(), _near_rows(3), []], ids=["edge", "near", "empty"])
@pytest.mark.parametrize("blocks", [(512, 4096), (2, 4)], ids=["plain", "refined"])
def test_simhash_components(spark, rows, blocks):
    from ledgerlens.llm.simhash import near_duplicates
    got = near_duplicates(docs_frame(spark, rows, clashing=True), block_mean=blocks[0], block_most=blocks[1]).collect()
    assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=str) == _expected(rows)


def test_bit_sliced_pairs():
    from ledgerlens.llm.simhash import _planes, near_pairs
    r = np.random.default_rng(0)
    base = r.integers(0, 1 << 64, 40, dtype=np.uint64, endpoint=False)
    flips = np.array([sum(1 << int(b) for b in r.choice(64, r.integers(0, 6), replace=False)) for _ in range(700)], np.uint64)
    fps = base[r.integers(0, 40, 700)] ^ flips
    for radius in (0, 1, 2, 3, 5):
        got = {(int(i), int(j)) for a, b in near_pairs(fps, _planes(fps), len(fps), radius, np.arange(len(fps))) for i, j in zip(a, b)}
        want = {(i, j) for i in range(700) for j in range(i + 1, 700) if bin(int(fps[i] ^ fps[j])).count("1") <= radius}
        assert got == want


def test_keep_one_each(spark):
    from ledgerlens.llm.simhash import keep_one_each
    rows = _near_rows(4) + edge_rows()
    frame = docs_frame(spark, rows, clashing=True)
    kept = keep_one_each(frame)
    assert kept.columns == frame.columns
    got = [(r.doc_id, r.text, r.source) for r in kept.collect()]
    fps = {(i, t, s): simhash(t) for i, t, s in rows}
    group = components(set(fps.values()), lambda a, b: bin(a ^ b).count("1") <= 3)
    names = [min(group[fps[x]]) for x in got]
    assert len(names) == len(set(names)) == len({min(g) for g in group.values()})
    for x in got:  # the smallest id of its group
        ids = [i for (i, t, s), f in fps.items() if f in group[fps[x]] and i is not None]
        assert x[0] == (min(ids) if ids else None)


@pytest.mark.parametrize("clash", [False, True])
def test_decontamination(spark, clash):
    from ledgerlens.llm.decontaminate import decontaminated
    from ledgerlens.llm.decontaminate import leaks as found
    r = random.Random(5)
    items = [(k, " ".join(f"B{r.randint(0, 60)}" for _ in range(n))) for k, n in enumerate([0, 1, 4, 5, 6, 9, 14, 15, 16, 30, 31, 33, 60, 130])]
    items += [(20, None), (21, items[-1][1]), (None, items[9][1])]
    rows = edge_rows()
    for k in range(80):
        text = words(r.choice(items)[1])
        for _ in range(r.randint(0, 3)):
            if text:
                text[r.randrange(len(text))] = "changed"
        pad = [f"pad{r.randint(0, 9)}" for _ in range(r.choice([0, 3, 500]))]
        rows.append((100 + k, " ".join(pad + (text.copy() if r.random() < 0.9 else text[:len(text) // 2]) + pad).swapcase(), "a"))
    frame = docs_frame(spark, rows, clashing=clash)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = leaks(rows, items)
    got = {(x.doc_id, x.item_id, x.n_shared, x.n_item) for x in found(frame, bench).collect()}
    assert got == want and len(want) > 20
    kept = decontaminated(frame, bench)
    assert kept.columns == frame.columns
    texts = {t for i, t, _ in rows if i in {w[0] for w in want}}
    assert sorted(str(x.doc_id) for x in kept.collect()) == sorted(str(i) for i, t, _ in rows if t not in texts)
    assert found(frame.limit(0), bench).count() == found(frame, bench.limit(0)).count() == 0


def test_short_items_leak_into_documents_of_their_words(spark):
    from ledgerlens.llm.decontaminate import leaks as found
    docs = docs_frame(spark, [(1, "Paris  is big", "a"), (2, "paris is big and old", "a"), (3, "one", "b"), (4, " ", "b"), (5, None, "b"), (6, "is big", "a")])
    items = spark.createDataFrame([(1, "paris is BIG"), (2, "One"), (3, " "), (4, None)], "item_id long, text string")
    assert sorted(tuple(r) for r in found(docs, items).select("doc_id", "item_id", "n_shared", "n_item").collect()) == [(1, 1, 1, 1), (3, 2, 1, 1)]


@pytest.mark.parametrize("limit", [0, 100_000])
def test_texts_stay_out_of_the_shingle_rows(spark, monkeypatch, limit):
    """On either side of the broadcast limits no plan shuffles shingle rows with a text, and the leaks are the same."""
    from ledgerlens.llm import common, decontaminate
    monkeypatch.setattr(common, "BROADCAST_ROWS", limit)
    plans, plain = [], decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or plain(df, name))
    r = random.Random(9)
    items = [(k, " ".join(f"b{r.randint(0, 400)}" for _ in range(r.choice([5, 20, 40])))) for k in range(60)]
    rows = [(k, " ".join([f"x{r.randint(0, 99)}"] * 7 + words(r.choice(items)[1])[r.choice([0, 0, 9]):] + ["end"] * 5), "a") for k in range(90)]
    got = decontaminate.leaks(docs_frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id, x.n_shared, x.n_item) for x in got.collect()} == leaks(rows, items)
    probing = next(p for name, p in plans if name == "candidates")
    for line in probing.split("\n"):
        if "Generate explode" in line or "Exchange" in line:
            assert "text#" not in line, line
    assert "Generate explode" in probing


def test_a_phrase_shared_by_all_items(spark):
    """20,000 items begin alike: the phrase is in no sketch of an item with words of its own."""
    from ledgerlens.llm.decontaminate import item_sketches, leaks as found
    phrase = "answer the following question in one short sentence please now"
    items = spark.range(20_000).select(F.col("id").alias("item_id"), F.concat(F.lit(phrase + " "), F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(24)), lambda k: F.concat(F.lit("w"), F.xxhash64("id", k).cast("string"))), " ")).alias("text"))
    some = {r.item_id: r.text for r in items.where("item_id % 4000 = 7").collect()}
    docs = [(k, f"{phrase} and nothing else of number {k} here", "a") for k in range(300)] + [(1000 + i, "so " + t + " then", "b") for i, t in some.items()]
    got = found(docs_frame(spark, docs), items).select("doc_id", "item_id").collect()
    assert sorted(tuple(r) for r in got) == sorted((1000 + i, i) for i in some)
    shared = item_sketches(items, 0.8, 5, "item_id", "text").select(F.explode("sketch").alias("h")).groupBy("h").count().agg(F.max("count")).first()[0]
    assert shared < 10


def test_token_counts_equal_the_library(spark):
    P = pytest.importorskip("public_tokenizers")
    import sentencepiece
    from ledgerlens.llm.token_counts import token_count, transducer
    path = str(P.path("piece_bpe_32k.model"))
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = edge_rows()
    got = docs_frame(spark, rows, clashing=True).select("text", token_count(F.col("text"), path).alias("n")).collect()
    assert sorted((str(x.text), x.n) for x in got) == sorted((str(t), len(lib.encode(t or ""))) for _, t, _ in rows)
    r, t = random.Random(0), transducer(path)
    pieces = [p.replace("▁", " ") for p in t.rank]
    for k in range(3000):
        x = "".join(r.choice(pieces) for _ in range(r.randint(0, 9))) if k % 2 else "".join(
            r.choice(" \n\t▁abcdethinoé一\U0001F600\x00<s>/.!A10'") for _ in range(r.randint(0, 40)))
        want = len(lib.encode(x))
        assert t.count(x, 1 << 16) == want, x
        assert t.count(x, r.randint(1, 9)) == want, x  # chunk maps composed by the scan


def test_chunk_maps_compose_associatively():
    P = pytest.importorskip("public_tokenizers")
    from ledgerlens.llm.token_counts import compose, fold, transducer
    t = transducer(str(P.path("piece_bpe_32k.model")))
    r = random.Random(1)
    for alphabet in ("▁\nabthe", "a", "=-", "thein"):
        for _ in range(100):
            text = "".join(r.choice(alphabet) for _ in range(r.randint(3, 300)))
            i, j = sorted(r.sample(range(1, len(text)), 2))
            a, b, c = t.chunk(text[:i]), t.chunk(text[i:j], text[:i][-90:]), t.chunk(text[j:], text[:j][-90:])
            whole = compose(compose(a, b), c)
            assert whole == compose(a, compose(b, c)) == fold(iter([a, b, c]))
            assert [n for _, n in whole.values()] in ([], [t.run(0, text)[1]])


def test_states_are_foreseen_in_repeated_and_random_texts(monkeypatch):
    """The joined map decides: the carried run, its exact way out, is not needed."""
    P = pytest.importorskip("public_tokenizers")
    import sentencepiece
    from ledgerlens.llm import token_counts as T
    path = str(P.path("piece_bpe_32k.model"))
    t, lib = T.transducer(path), sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(5)
    texts = ["a" * 3001, "ab" * 1999, "=" * 2500, " " * 777, "".join(r.choice("abcdefABC0123+/=") for _ in range(5000)), "the quick brown fox " * 300]
    want = [len(lib.encode(x)) for x in texts]
    assert [t.count(x, n) for x in texts for n in (100, 333)] == [w for w in want for _ in range(2)]
    monkeypatch.setattr(T.Transducer, "carried", lambda *a: pytest.fail("a state was not foreseen"))
    assert [t.count(x, 333) for x in texts] == want


@pytest.mark.parametrize("blind", [False, True])
def test_long_texts_are_dealt_over_tasks(spark, monkeypatch, blind):
    """Texts over the limit give the library's counts, repeated and odd rows included; so do those whose states were not foreseen."""
    P = pytest.importorskip("public_tokenizers")
    import sentencepiece
    from ledgerlens.llm import token_counts as T
    path = str(P.path("piece_bpe_32k.model"))
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(6)
    rows = [(1, "word é一\n " * 400), (1, "word é一\n " * 400), (None, "x\U0001F600" * 900), (2, "a" * 5000), (3, None), (4, ""), (5, "short"),
            (6, "".join(r.choice("abcXYZ019+/") for _ in range(7000))), (7, " " * 3000)]
    if blind:  # maps without the start state
        monkeypatch.setattr(T, "_joined", lambda pdf: pd.DataFrame({"key": [pdf.key.iloc[0]], "n": pd.array([None], dtype="Int64")}))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("own")).withColumn("n_tokens", F.lit("x")).withColumn("block", F.lit(1))
    got = T.counted(docs, path, long_bytes=1000, chunk_chars=50, block_chunks=8)
    assert sorted(got.columns) == ["block", "doc_id", "key", "n_bytes", "n_tokens"]
    want = sorted((str(i), len((t or "").encode()), len(lib.encode(t or ""))) for i, t in rows)
    assert sorted((str(x.doc_id), x.n_bytes, x.n_tokens) for x in got.collect()) == want
    assert T.counted(docs.where("false"), path).collect() == []


def test_other_models_are_refused():
    P = pytest.importorskip("public_tokenizers")
    from ledgerlens.llm.token_counts import bpe_pieces

    def message(**kind):  # a model of one piece; field numbers of the public schema
        trainer = b"\x18" + bytes([kind.get("model_type", 2)]) + b"\x98\x02" + bytes([kind.get("byte_fallback", 1)])
        normalizer = b"\x18" + bytes([kind.get("prefix", 1)]) + b"\x20" + bytes([kind.get("squeeze", 0)]) + kind.get("charsmap", b"")
        piece = b"\x0a\x01a\x18" + bytes([kind.get("piece", 1)])
        return b"".join(tag + bytes([len(m)]) + m for tag, m in ((b"\x0a", piece), (b"\x12", trainer), (b"\x1a", normalizer)))

    assert bpe_pieces(message()) == [("a", 0.0)]
    for other in ({"model_type": 1}, {"byte_fallback": 0}, {"prefix": 0}, {"squeeze": 1}, {"charsmap": b"\x12\x01x"}, {"piece": 4}):
        with pytest.raises(ValueError):
            bpe_pieces(message(**other))
    assert len(bpe_pieces(open(P.path("piece_bpe_32k.model"), "rb").read())) > 30_000


def test_long_text_without_a_synchronising_point():
    """24 million characters without space or newline: counted in linear memory, and exactly."""
    P = pytest.importorskip("public_tokenizers")
    import resource
    import subprocess
    import sys
    from pathlib import Path

    import sentencepiece
    path = str(P.path("piece_bpe_32k.model"))
    r = random.Random(3)
    part = "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCXYZ0123456789+/=一é") for _ in range(3000))
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    few = [len(lib.encode(part * k)) for k in (4, 5)]
    code = ("import resource, sys; from ledgerlens.llm.token_counts import transducer; part, path = sys.argv[1:]; t = transducer(path);"
            "print(t.count(part * 5, 1000), t.count(part * 8000, 65536), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)")
    most = (2 << 30, 2 << 30)  # all prefixes of its chunks would be 4e9 characters
    out = subprocess.run([sys.executable, "-c", code, part, path], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=600,
                         preexec_fn=lambda: resource.setrlimit(resource.RLIMIT_AS, most))
    assert out.returncode == 0, out.stderr[-500:]
    small, whole, peak_kb = map(int, out.stdout.split())
    assert small == few[1] and whole == few[0] + (8000 - 4) * (few[1] - few[0]) and peak_kb < 1 << 20


def test_carried_state_survives_full_tables(monkeypatch):
    P = pytest.importorskip("public_tokenizers")
    from ledgerlens.llm import token_counts as T
    r = random.Random(4)
    text = "".join(r.choice("abcdefghinorstABC0123+/=一é") for _ in range(20_000))
    path = str(P.path("piece_bpe_32k.model"))
    want = T.transducer(path).count(text, 1 << 20)
    monkeypatch.setattr(T, "MOST_STATES", 50)
    t = T.transducer.__wrapped__(path)
    assert t.count(text, 100) == t.count(text, 7) == want
