"""Exact token counts by a finite-state transducer compiled from a BPE model.

Method.  Of a merge-by-rank tokenizer every prefix of a text has exactly one
last token, and a token sequence is the tokenizer's output exactly if every two
neighbours, tokenized alone, stay as they are.  So a left-to-right automaton
suffices.  Its state holds, for every place where a piece may still be growing,
the trie node reached, the last token before that place and the tokens emitted
since.  Pieces are of bounded length, so the states are finite.  Each
transition on a character carries the change of the token count.  States and
transitions are compiled when first met and kept for the life of the worker.

No piece holds a space mark after another character, and characters of no piece
never merge, so the automaton is back in its start state there (synchronising
points).  A chunk's map gives, for every state it may meet, the state it leaves
behind and its tokens.  Which states it may meet is read off the characters before
it: from a synchronising point on there is one, without any the automaton is
started at each of the last places a piece could begin, and equal states merge.
Such maps compose associatively, so neighbours are joined in a tree (the last
value of a prefix scan).  A map names states by their content, not by a worker's
numbers, so ``counted`` deals the chunks of a long text over tasks and joins the
maps after a shuffle.  If a chunk meets a state that was not foreseen, the joined
map lacks the start state, and that text is run again from its start, one chunk
after the other: the count is exact either way.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import shield, stored

SPACE = "▁"
#: States, transitions' words and merge checks kept per worker; when a table is
#: full it starts anew, which changes the speed only.
MOST_STATES, MOST_WORDS = 200_000, 600_000
#: Up to so many pieces going on from a trie node, its predecessors are classed.
FEW = 40


#: Characters of a chunk, chunks of a block (one task's share of a long text), and bytes
#: from which a text's blocks are dealt over tasks.
CHUNK, BLOCK_CHUNKS, LONG_BYTES = 65536, 16, 1 << 20
#: Characters read before a chunk, besides a piece's longest, to foresee its states;
#: characters after which states that became equal are merged.
LOOK, STRIDE = 64, 1024

#: What a chunk does to the states it may meet: state -> (state after it, tokens).
ChunkMap = dict[str, tuple[str, int]]
START = json.dumps([[0, "", 0]])


def key_parts(left: str, right: str) -> tuple[str, ...]:
    return (left, right) if left else (right,)


class Transducer(dict):
    """word -> token count, filled by running the automaton over the word."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        ranked = sorted(pieces, key=lambda p: -p[1])
        self.rank = {p: i for i, (p, _) in enumerate(ranked)}
        known = set("".join(self.rank))
        self.trie: list[dict[str, int]] = [{}]
        self.piece: list[str | None] = [None]
        for p in self.rank:
            node = 0
            for c in p:
                nxt = self.trie[node].get(c)
                if nxt is None:
                    nxt = self.trie[node][c] = len(self.trie)
                    self.trie.append({})
                    self.piece.append(None)
                node = nxt
            self.piece[node] = p
        self.known = known
        self.longest = max(map(len, self.rank), default=1)
        inner = any(SPACE in p.lstrip(SPACE) for p in self.rank)
        sync = "" if "\n" in known else "\n"
        if inner:  # a piece spans words: only characters of no piece synchronise
            self.words = re.compile(f"\n|[^\n]+" if sync else r"(?s).+").findall
        else:
            self.words = re.compile(f"{sync}|" * bool(sync) + f"{SPACE}+[^{SPACE}{sync}]*|[^{SPACE}{sync}]+").findall
        self._fits: dict[tuple[str, str], bool] = {}
        self._below: dict[int, tuple[str, ...] | None] = {}
        self._splits: dict[str, tuple[str, str] | None] = {}
        self._reset()

    # -- compilation ------------------------------------------------------
    def _reset(self, carried: int = 0) -> int:
        """Empty tables but for one state; its new number."""
        start = ((0, "", 0),)
        held, members = (self.states[carried], self._members) if carried else (start, [])
        self.states, self.ids, self.steps = [start], {start: 0}, [{}]
        self._kin: dict[tuple[int, str | int], str | int | None] = {}
        self._classes: dict[tuple[str, ...], int] = {}
        self._members: list[tuple[str, ...]] = []
        if not carried:
            return 0
        key = tuple([(n, self._class(members[b]) if b.__class__ is int else b, s) for n, b, s in held])
        self.ids[key] = 1
        self.states.append(key)
        self.steps.append({})
        return 1

    def _class(self, allowed: tuple[str, ...]) -> int:
        """The number of a class of tokens, by the pieces that may follow them."""
        out = self._classes.setdefault(allowed, len(self._classes))
        if out == len(self._members):
            self._members.append(allowed)
        return out

    def merged(self, text: str) -> list[str]:
        """The tokenizer's merges on a short string: best rank first, leftmost."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = min((rank.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
            if best == 1 << 40:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split(self, token: str) -> tuple[str, str] | None:
        """The last merge that makes ``token`` out of its characters; None if it
        is never made, or if a part ranks after the whole (merge order is then
        not the order of ranks)."""
        if token not in self._splits:
            parts, out = list(token), None
            while len(parts) > 1:
                best, at = min((self.rank.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
                if best == 1 << 40:
                    out = None
                    break
                out = (parts[at], parts[at + 1])
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            if out and any(len(x) > 1 and (self.rank[x] > self.rank[token] or self.split(x) is None) for x in out):
                out = None
            self._splits[token] = out
        return self._splits[token]

    def fits(self, left: str, right: str) -> bool:
        """Whether the two stay apart and whole when they stand side by side."""
        if left.__class__ is int:
            return right in self._members[left]
        key = (left, right)
        ok = self._fits.get(key)
        if ok is None:
            if len(self._fits) > 2 * MOST_STATES:
                self._fits.clear()
            ok = self._fits[key] = self._apart(left, right)
        return ok

    def _apart(self, left: str, right: str) -> bool:
        if any(len(x) > 1 and self.split(x) is None for x in key_parts(left, right)):
            return self.merged(left + right) == ([left, right] if left else [right])
        if not left:
            return True
        # undo the merges of both sides, the latest first; the pair that meets at
        # the seam must never have been the better choice
        rank, seam, limit = self.rank, self._splits, 1 << 40
        while True:
            if rank.get(left + right, 1 << 40) < limit:
                return False
            a = rank[left] if len(left) > 1 else -1
            b = rank[right] if len(right) > 1 else -1
            if a > b:
                limit, left = a, seam[left][1]
            elif b >= 0:
                limit, right = b + 1, seam[right][0]
            else:
                return True

    def below(self, node: int) -> tuple[str, ...] | None:
        """The pieces that go on from a trie node; None if they are many."""
        out = self._below.get(node, 0)
        if out == 0:
            found, todo = [], list(self.trie[node].values())
            while todo and len(found) <= FEW:
                n = todo.pop()
                if self.piece[n] is not None:
                    found.append(self.piece[n])
                todo.extend(self.trie[n].values())
            out = self._below[node] = tuple(sorted(found)) if len(found) <= FEW else None
        return out

    def kin(self, node: int, before: str | int) -> str | int | None:
        """``before`` as far as it matters at ``node``: tokens that let the same
        pieces follow are one class, so fewer states differ; None if no piece
        from here on can follow it."""
        key = (node, before)
        if key not in self._kin:
            pieces = self.below(node)
            if pieces is None:
                out = before
            else:
                allowed = tuple(p for p in pieces if self.fits(before, p))
                out = self._class(allowed) if allowed else None
            self._kin[key] = out
        return self._kin[key]

    def cost(self, token: str) -> int:
        return 1 if token in self.rank else len(token.encode("utf-8", "surrogatepass"))

    def step(self, state: int, c: str) -> tuple[int, int]:
        """(next state, change of the token count) on character ``c``."""
        if c not in self.known:
            out = (0, self.cost(c))
        else:
            grown, last, change = [], None, 0
            for node, before, since in self.states[state]:
                child = self.trie[node].get(c)
                if child is None:
                    if node or not self.fits(before, c):
                        continue
                    last, change = c, self.cost(c) - since
                    continue
                token = self.piece[child] or (c if not node else None)
                if last is None and token is not None and self.fits(before, token):
                    last, change = token, self.cost(token) - since
                if self.trie[child] and (kin := self.kin(child, before)) is not None:
                    grown.append((child, kin, since))
            key = tuple([(n, b, s + change) for n, b, s in grown] + [(0, last, 0)])
            nxt = self.ids.get(key)
            if nxt is None:
                nxt = self.ids[key] = len(self.states)
                self.states.append(key)
                self.steps.append({})
            out = (nxt, change)
        self.steps[state][c] = out
        return out

    # -- running ----------------------------------------------------------
    def run(self, state: int, text: str) -> tuple[int, int]:
        """(next state, change of the token count) on the characters of ``text``."""
        if len(self.states) > MOST_STATES:
            state = self._reset(state)
        steps, n = self.steps, 0
        for c in text:
            nxt = steps[state].get(c)
            state, change = nxt if nxt is not None else self.step(state, c)
            n += change
        return state, n

    def __missing__(self, word: str) -> int:
        n = self.run(0, word)[1]
        if len(self) > MOST_WORDS:
            self.clear()
        if len(word) < 64:
            self[word] = n
        return n

    def total(self, words: list[str]) -> int:
        return sum(map(self.__getitem__, words))

    def name(self, state: int) -> str:
        """A state by its content, the same in every worker."""
        return json.dumps([[n, self._members[b] if b.__class__ is int else b, s] for n, b, s in self.states[state]])

    def named(self, name: str) -> int:
        """This worker's number of a state."""
        key = tuple([(n, self._class(tuple(b)) if b.__class__ is list else b, s) for n, b, s in json.loads(name)])
        out = self.ids.get(key)
        if out is None:
            out = self.ids[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        return out

    def incoming(self, before: str | None) -> list[str]:
        """The states that may hold after ``before``, the characters before a chunk
        (None: the chunk begins the text)."""
        if before is None:
            return [START]
        words = self.words(before)
        starts = [words[-1]] if len(words) > 1 else [before[i:] for i in range(min(len(before), self.longest))]
        return list(dict.fromkeys(self.name(self.run(0, w)[0]) for w in starts))

    def chunk(self, text: str, before: str | None = None) -> ChunkMap:
        """The map of a chunk that comes after ``before``."""
        met, words = self.incoming(before), self.words(text)
        if len(words) > 1:
            inner = self.total(words[1:-1])
            state, last = self.run(0, words[-1])
            after = self.name(state)
            return {m: (after, self.run(self.named(m), words[0])[1] + inner + last) for m in met}
        out = {m: (m, 0) for m in met}
        for i in range(0, len(text), STRIDE):
            step = {}
            for m in {m for m, _ in out.values()}:
                state, n = self.run(self.named(m), text[i:i + STRIDE])
                step[m] = (self.name(state), n)
            out = compose(out, step)
        return out

    def maps(self, text: str, chunk_chars: int, before: str | None = None) -> Iterator[ChunkMap]:
        """The maps of the chunks of ``text``, which comes after ``before``."""
        look = LOOK + self.longest
        for i in range(0, len(text), chunk_chars):
            yield self.chunk(text[i:i + chunk_chars], text[max(0, i - look):i] if i else before)

    def count(self, text: str, chunk_chars: int = CHUNK) -> int:
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if len(text) <= chunk_chars:
            return self.total(self.words(text))
        whole = fold(self.maps(text, chunk_chars))
        return whole[START][1] if START in whole else self.carried(text, chunk_chars)

    def carried(self, text: str, chunk_chars: int) -> int:
        """The count by one state carried from chunk to chunk."""
        state = n = 0
        for i in range(0, len(text), chunk_chars):
            state, change = self.run(state, text[i:i + chunk_chars])
            n += change
        return n


def compose(a: ChunkMap, b: ChunkMap) -> ChunkMap:
    """The map of chunk ``a`` followed by ``b``, for the states of ``a`` whose
    outcome ``b`` has foreseen."""
    return {m: (b[mid][0], n + b[mid][1]) for m, (mid, n) in a.items() if mid in b}


def fold(maps: Iterator[ChunkMap]) -> ChunkMap:
    """All maps joined in order, neighbours first, as a tree."""
    level = list(maps)
    while len(level) > 1:
        level = [compose(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0] if level else {START: (START, 0)}


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at:at + size]
            at += size


def bpe_pieces(model: bytes) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model's ordinary pieces.  Raises ValueError
    unless it is a BPE model with byte fallback, no normalisation beyond a leading
    space mark, and no pieces defined by its user."""
    # numbers of the public sentencepiece_model.proto, fixed values
    pieces, trainer, normalizer = [], {}, {}
    for number, value in _fields(model):
        if number == 1:
            f = dict(_fields(value))
            kind = f.get(3, 1)  # 1 normal, 2 unknown, 3 control, 4 user defined, 5 unused, 6 byte
            if kind in (4, 5):
                raise ValueError("pieces that are user defined or unused are not supported")
            if kind == 1:
                pieces.append((f[1].decode("utf-8"), struct.unpack("<f", f.get(2, bytes(4)))[0]))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normalizer = dict(_fields(value))
    if trainer.get(3, 1) != 2:  # model_type: 1 unigram, 2 BPE, 3 word, 4 char
        raise ValueError("not a BPE model")
    if not trainer.get(35, 0) or trainer.get(24, 0):  # byte_fallback, treat_whitespace_as_suffix
        raise ValueError("the model needs byte fallback and space marks in front of words")
    # precompiled_charsmap, add_dummy_prefix, remove_extra_whitespaces, escape_whitespaces
    if normalizer.get(2) or not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1):
        raise ValueError("the model must not normalise texts beyond a leading space mark")
    return pieces


@lru_cache(maxsize=2)
def transducer(model_path: str) -> Transducer:
    """The transducer of a model that ``bpe_pieces`` accepts; one per worker process."""
    with open(model_path, "rb") as f:
        return Transducer(bpe_pieces(f.read()))


def token_count(text: Column, model_path: str, chunk_chars: int = CHUNK) -> Column:
    """Number of tokens (long) of each whole text; null and empty texts have 0.

    ``model_path``: a sentencepiece BPE model file present on every node.
    Other columns, repeated rows and row order are untouched, since this is a
    column.  One text is handled in one task in time linear in its length;
    ``counted`` deals long ones over tasks.
    """

    @F.pandas_udf("long")
    def counts(texts: pd.Series) -> pd.Series:
        t = transducer(model_path)
        return pd.Series([0 if x is None else t.count(x, chunk_chars) for x in texts], dtype="int64")

    return counts(text)


def _block_map(model_path: str, chunk_chars: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        t = transducer(model_path)
        first = pdf.iloc[0]
        text, before = first.text.replace(" ", SPACE), first.before
        if first.block == 0:
            text, before = SPACE + text, None
        else:
            before = before.replace(" ", SPACE)
        return pd.DataFrame({"key": [first.key], "block": [first.block], "map": [json.dumps(fold(t.maps(text, chunk_chars, before)))]})

    return run


def _joined(pdf: pd.DataFrame) -> pd.DataFrame:
    whole = fold(json.loads(m) for m in pdf.sort_values("block")["map"])
    return pd.DataFrame({"key": [pdf.key.iloc[0]], "n": pd.array([whole[START][1] if START in whole else None], dtype="Int64")})


def long_counts(texts: DataFrame, model_path: str, chunk_chars: int = CHUNK, block_chunks: int = BLOCK_CHUNKS) -> DataFrame:
    """key, n_tokens of ``texts`` (key, text; a key once): blocks of each text are
    cut in the JVM and dealt over tasks, which return their maps; a text's maps are
    joined after that.  A text whose joined map lacks the start state is counted whole."""
    size, look = chunk_chars * block_chunks, LOOK + max(len(p) for p in transducer(model_path).rank)
    parts = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    cut = texts.select("key", parts.alias("parts")).select("key", F.inline(F.transform("parts", lambda x, i: F.struct(
        i.alias("block"), x.alias("text"), F.when(i > 0, F.substring(F.get("parts", i - 1), -look, look)).alias("before")))))
    maps = cut.groupBy("key", "block").applyInPandas(_block_map(model_path, chunk_chars), "key string, block int, map string")
    joined = stored(maps.groupBy("key").applyInPandas(_joined, "key string, n long"), "token-maps")
    again = texts.join(joined.where("n is null"), "key", "left_semi").select("key", token_count(F.col("text"), model_path, chunk_chars).alias("n_tokens"))
    return joined.where("n is not null").select("key", F.col("n").alias("n_tokens")).unionByName(again)


def counted(docs: DataFrame, model_path: str, text_col: str = "text", long_bytes: int = LONG_BYTES, chunk_chars: int = CHUNK,
            block_chunks: int = BLOCK_CHUNKS) -> DataFrame:
    """``docs`` with n_bytes and n_tokens (long) in place of the text.

    Null and empty texts have 0 of both.  Rows are kept as they are, repeated ones
    and null ids included; further columns stay, except that n_bytes and n_tokens
    are replaced.  Texts over ``long_bytes`` are written once; equal ones are counted
    once, by the 256-bit digest of the text, their blocks in parallel; the other
    texts are counted where they are scanned.
    """
    inner, (text,), back = shield(docs, text_col)
    back = [c for c, n in zip(back, docs.columns, strict=True) if n not in (text_col, "n_bytes", "n_tokens")]
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    short = inner.where(size <= long_bytes).select(*back, size.alias("n_bytes"), token_count(F.col(text), model_path, chunk_chars).alias("n_tokens"))
    rows = stored(inner.where(size > long_bytes).withColumn("key", F.sha2(text, 256)), "long-texts")
    texts = rows.select("key", F.col(text).alias("text")).dropDuplicates(["key"])
    counts = long_counts(texts, model_path, chunk_chars, block_chunks)
    return short.unionByName(rows.join(counts, "key").select(*back, size.alias("n_bytes"), "n_tokens"))
