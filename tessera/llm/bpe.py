"""BPE encoding and decoding by speculation and verification (operator 6).

A word is first cut by greedy longest match. A cut is the true BPE result exactly when every two
neighbouring tokens are compatible, that is when no merge would have joined them across their
border. All distinct pairs of a batch are tested together on arrays: for a pair (a, b) the right
edge of a's merge tree and the left edge of b's are compared level by level, and a crossing merge
of rank r breaks the pair if both edge nodes are still whole when r comes up. Only words with a
broken pair are merged exactly.

Edge cases: null text is the empty text; empty text has no ids and decodes to ""; the two special
token strings in a text are read as those tokens, as the tokenizers library does; a text of one
very long word is cut, verified and (if need be) merged in O(n log n); input columns other than
the key and the text are ignored, repeated rows give repeated results, an empty table an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ragged_take, table, text_of

#: Distinct words remembered by a task before its memory is cleared (a bound on memory only).
MAX_REMEMBERED = 300_000
#: Longer words are merged one at a time on a heap.
MAX_WORD_BYTES = 64
#: Characters of text worked on at once.
PIECE_CHARS = 3_000_000

NEVER = 1 << 30


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_alphabet() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, others from U+0100 on."""
    plain = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    out, extra = [], 0
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(0x100 + extra))
            extra += 1
    return out


class Lookup:
    """Static map from int64 keys to non-negative int32 values, asked for whole arrays of keys."""

    def __init__(self, keys, values):
        import numpy as np

        self.bits = max(4, int(len(keys) * 8).bit_length())
        slot = self._slot(np.asarray(keys, np.int64))
        order = np.argsort(slot, kind="stable")
        self.keys = np.append(np.asarray(keys, np.int64)[order], -1)
        self.values = np.append(np.asarray(values, np.int32)[order], -1)
        self.start = np.searchsorted(slot[order], np.arange((1 << self.bits) + 1)).astype(np.int32)
        self.deep = int(np.diff(self.start).max()) if len(keys) else 0

    def _slot(self, keys):
        import numpy as np

        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).view(np.int64)

    def get(self, keys):
        """The values, -1 for unknown keys."""
        import numpy as np

        slot = self._slot(keys)
        at, end = self.start[slot], self.start[slot + 1]
        out = np.where((self.keys[at] == keys) & (at < end), self.values[at], -1)
        for k in range(1, self.deep):
            left = np.flatnonzero((out < 0) & (at + k < end))
            if not len(left):
                break
            x = at[left] + k
            out[left] = np.where(self.keys[x] == keys[left], self.values[x], -1)
        return out


class WordBpe:
    """Vocabulary, merges and the word-level encoder; made once per task from the tokenizer file."""

    def __init__(self, path: str):
        import json
        import re

        import numpy as np
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab = vocab = model["vocab"]
        self.token = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token.update({i: t for t, i in self.special.items()})
        self.special_re = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.word_re = regex.compile(split)
        # the same pattern with the classes written out, for texts without characters over U+00FF
        letter, number, blank = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
        plain = split.replace(r"[^\s\p{L}\p{N}]", f"[^{blank}{letter}{number}]").replace(r"\p{L}", letter).replace(r"\p{N}", number)
        self.latin_re = re.compile(plain) if r"\p" not in plain and r"\s" not in plain else self.word_re
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> (rank, merged id)
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        made: dict[int, int] = {}
        self.proper = True  # every merge comes after those that make its parts
        for (a, b), (rank, c) in self.merges.items():
            if made.get(a, -1) >= rank or made.get(b, -1) >= rank:
                self.proper = False
            made.setdefault(c, rank)
        self.rank_of = Lookup([a << 32 | b for a, b in self.merges], [r for r, _ in self.merges.values()])
        self.merged = np.zeros(len(model["merges"]) + 1, np.int32)
        for rank, c in self.merges.values():
            self.merged[rank] = c
        alphabet = byte_alphabet()
        self.first_ids = np.array([vocab[c] for c in alphabet], np.int64)
        self.last_ids = np.array([vocab[c + self.suffix] for c in alphabet], np.int64)
        self.edges: dict[int, tuple | None] = {}
        self._trie()
        self.pairs = (np.zeros(0, np.int64), np.zeros(0, bool))

    def parts(self, token: int) -> list[int]:
        """The symbol ids of a token."""
        t = self.token[token]
        if self.suffix and t.endswith(self.suffix) and len(t) > len(self.suffix):
            bare = t[: -len(self.suffix)]
            return [self.vocab[c] for c in bare[:-1]] + [self.vocab[bare[-1] + self.suffix]]
        return [self.vocab[c] for c in t]

    def _trie(self) -> None:
        """All tokens as a trie over symbol ids: (node, symbol) -> node, and the token that ends there."""
        import numpy as np

        child: dict[int, int] = {}
        ends = [-1]
        for i in self.vocab.values():
            node = 0
            for s in self.parts(i):
                k = node << 32 | s
                node = child.get(k, -1)
                if node < 0:
                    node = child[k] = len(ends)
                    ends.append(-1)
            ends[node] = i
        self.child = Lookup(list(child), list(child.values()))
        self.ends = np.array(ends, np.int32)

    # -- text -> words ---------------------------------------------------------------------------
    def words(self, text: str) -> list[str]:
        """Pre-tokens of normalised text; special tokens stay as they are, marked by a NUL in front."""
        if not self.special_re or "<" not in text or not self.special_re.search(text):
            return self.plain_words(text)
        out: list[str] = []
        for piece in self.special_re.split(text):
            if piece in self.special:
                out.append("\x00" + piece)
            else:
                out += self.plain_words(piece)
        return out

    def plain_words(self, text: str) -> list[str]:
        if text.isascii():
            return self.latin_re.findall(text.lower())
        import unicodedata

        # a final capital sigma has its own lower case in Python only
        text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.word_re.findall(text)
        return self.latin_re.findall(text)

    # -- exact merging ---------------------------------------------------------------------------
    def merge(self, ids: list[int], tree: bool = False):
        """Exact BPE over symbol ids, lowest rank first, leftmost first. With ``tree``: also each
        merge as (rank, left id, right id, first position, last position)."""
        import heapq

        n = len(ids)
        ids = list(ids)
        nxt = list(range(1, n + 1))
        prv = list(range(-1, n - 1))
        last = list(range(n))
        heap = []
        get = self.merges.get
        for i in range(n - 1):
            m = get((ids[i], ids[i + 1]))
            if m:
                heap.append((m[0], i, ids[i], ids[i + 1], m[1]))
        heapq.heapify(heap)
        done = []
        while heap:
            rank, i, a, b, c = heapq.heappop(heap)
            j = nxt[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            done.append((rank, a, b, i, last[j]))
            ids[i], ids[j] = c, -1
            last[i] = last[j]
            nxt[i] = k = nxt[j]
            if k < n:
                prv[k] = i
                m = get((c, ids[k]))
                if m:
                    heapq.heappush(heap, (m[0], i, c, ids[k], m[1]))
            if (h := prv[i]) >= 0:
                m = get((ids[h], c))
                if m:
                    heapq.heappush(heap, (m[0], h, ids[h], c, m[1]))
        out = [x for x in ids if x >= 0]
        return (out, done) if tree else out

    def merge_rows(self, ids):
        """Exact BPE of many short words: rows of symbol ids padded by -1. Each step merges the lowest
        (leftmost) pair of every row."""
        import numpy as np

        ids = ids.copy()
        done = np.empty_like(ids)
        rows = np.arange(len(ids))
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        cols = np.arange(ids.shape[1])
        while len(rows):
            j = ranks.argmin(1)
            here = np.arange(len(rows))
            r = ranks[here, j]
            on = r < NEVER
            if not on.all():
                done[rows[~on]] = ids[~on]
                rows, ids, ranks, j, r = rows[on], ids[on], ranks[on], j[on], r[on]
                here = np.arange(len(rows))
                if not len(rows):
                    break
            ids[here, j] = self.merged[r]
            shifted = np.minimum(cols + (cols > j[:, None]), len(cols) - 1)
            ids = np.take_along_axis(ids, shifted, 1)
            ids[:, -1] = -1
            ranks = np.take_along_axis(ranks, np.minimum(shifted[:, :-1], len(cols) - 2), 1)
            ranks[:, -1] = NEVER
            ranks[here, j] = np.where(j < len(cols) - 1, self._ranks(ids[here, j], ids[here, np.minimum(j + 1, len(cols) - 1)]), NEVER)
            h = np.flatnonzero(j > 0)
            ranks[h, j[h] - 1] = self._ranks(ids[h, j[h] - 1], ids[h, j[h]])
        return done

    def _ranks(self, a, b):
        import numpy as np

        key = (a << 32) | np.maximum(b, 0)
        r = self.rank_of.get(key.ravel()).reshape(key.shape).astype(np.int64)
        return np.where((r >= 0) & (a >= 0) & (b >= 0), r, NEVER)

    # -- speculation -----------------------------------------------------------------------------
    def greedy(self, symbols, starts, ends):
        """Longest-match cut of all words at once: (word number, token) in text order."""
        import numpy as np

        n = len(symbols)
        stop = np.repeat(ends, ends - starts)
        best, length = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        at = np.arange(n)
        node = np.zeros(n, np.int64)
        d = 0
        while len(at):
            node = self.child.get(node << 32 | symbols[at + d]).astype(np.int64)
            on = node >= 0
            at, node = at[on], node[on]
            token = self.ends[node]
            hit = token >= 0
            best[at[hit]], length[at[hit]] = token[hit], d + 1
            d += 1
            on = at + d < stop[at]
            at, node = at[on], node[on]
        word, cur = np.arange(len(starts)), starts.copy()
        words, tokens = [], []
        while len(word):
            words.append(word)
            tokens.append(best[cur])
            cur = cur + length[cur]
            on = cur < ends[word]
            word, cur = word[on], cur[on]
        words, tokens = np.concatenate(words), np.concatenate(tokens)
        order = np.argsort(words, kind="stable")
        return words[order], tokens[order]

    # -- verification ----------------------------------------------------------------------------
    def edge(self, token: int):
        """((left edge ids, deaths), (right edge ids, deaths)) of the token's merge tree, or None if
        merging its symbols doesn't give the token. A node's death is the rank of the merge that
        takes it up; the token itself never dies."""
        if token in self.edges:
            return self.edges[token]
        symbols = self.parts(token)
        ids, done = self.merge(symbols, tree=True)
        if ids != [token]:
            self.edges[token] = None
            return None
        n = len(symbols)
        left = [(a, rank) for rank, a, _, i, _ in done if i == 0] + [(token, NEVER)]
        right = [(b, rank) for rank, _, b, _, j in done if j == n - 1] + [(token, NEVER)]
        self.edges[token] = (left, right)
        return self.edges[token]

    def compatible(self, keys):
        """Whether no merge crosses the border of each pair a << 32 | b. Distinct pairs are tested
        together, one step for each two levels of the merge trees, and remembered."""
        import numpy as np

        wanted = np.unique(keys)
        known, good = self.pairs
        fresh = wanted[~np.isin(wanted, known, assume_unique=True)]
        if len(fresh):
            a, b = fresh >> 32, fresh & 0xFFFFFFFF
            (ra, la, wa), (rb, lb, wb) = self._edges(a, 1), self._edges(b, 0)
            ok = wa & wb
            for i in range(ra.shape[1]):
                for j in range(rb.shape[1]):
                    on = np.flatnonzero(ok & (ra[:, i] >= 0) & (rb[:, j] >= 0))
                    if not len(on):
                        break
                    rank = self.rank_of.get(ra[on, i] << 32 | rb[on, j])
                    # same rank: the leftmost goes first, so a's own merge wins and b's own loses
                    ok[on] = ~((rank >= 0) & (rank < la[on, i]) & (rank <= lb[on, j]))
            known, good = np.concatenate([known, fresh]), np.concatenate([good, ok])
            order = np.argsort(known)
            known, good = self.pairs = (known[order], good[order])
        return good[np.searchsorted(known, keys)]

    def _edges(self, tokens, side: int):
        """Edge nodes and their deaths of each token, padded by -1, and whether the token is its own merge."""
        import numpy as np

        kinds, back = np.unique(tokens, return_inverse=True)
        edges = [self.edge(t) for t in kinds.tolist()]
        deep = max((len(e[side]) for e in edges if e), default=1)
        ids, death = np.full((len(kinds), deep), -1, np.int64), np.full((len(kinds), deep), -1, np.int64)
        for k, e in enumerate(edges):
            if e:
                ids[k, : len(e[side])] = [x for x, _ in e[side]]
                death[k, : len(e[side])] = [r for _, r in e[side]]
        whole = np.array([e is not None for e in edges], bool)
        return ids[back], death[back], whole[back]

    def encode_words(self, words: list[str]):
        """(flat ids, ids per word, number of words that needed exact merging)."""
        import numpy as np

        plain = [k for k, w in enumerate(words) if not (w[0] == "\x00" and w[1:] in self.special)]
        raw = [words[k].encode("utf-8") for k in plain]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(lens)
        starts = ends - lens
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.first_ids[data]
        symbols[ends - 1] = self.last_ids[data[ends - 1]]
        word, token = self.greedy(symbols, starts, ends) if raw else (np.zeros(0, np.int64),) * 2
        bad = np.zeros(len(raw), bool)
        if self.proper:
            inner = np.flatnonzero(word[1:] == word[:-1])
            bad[word[inner[~self.compatible(token[inner] << 32 | token[inner + 1])]]] = True
            counts = np.bincount(word, minlength=len(raw))
            alone = np.flatnonzero(counts[word] == 1)
            if len(alone):
                kinds, back = np.unique(token[alone], return_inverse=True)
                own = np.array([self.edge(t) is not None for t in kinds.tolist()], bool)
                bad[word[alone[~own[back]]]] = True
        else:
            bad[:] = True
        keep = ~bad[word]
        out_word, out_token = [word[keep]], [token[keep]]
        todo = np.flatnonzero(bad)
        short = todo[lens[todo] <= MAX_WORD_BYTES]
        short = short[np.argsort(lens[short], kind="stable")]
        for at in range(0, len(short), 8192):
            w = short[at : at + 8192]
            wide = int(lens[w].max()) + 1
            cols = np.arange(wide)
            inside = cols < lens[w][:, None]
            rows = np.where(inside, symbols[np.minimum(starts[w][:, None] + cols, len(symbols) - 1)], -1)
            rows = self.merge_rows(rows)
            r, c = np.nonzero(rows >= 0)
            out_word.append(w[r])
            out_token.append(rows[r, c])
        for w in todo[lens[todo] > MAX_WORD_BYTES].tolist():
            ids = self.merge(symbols[starts[w] : ends[w]].tolist())
            out_word.append(np.full(len(ids), w))
            out_token.append(np.array(ids, np.int64))
        place = np.array(plain, np.int64)
        special = [k for k, w in enumerate(words) if w[0] == "\x00" and w[1:] in self.special]
        word = np.concatenate([place[x] for x in out_word] + [np.array(special, np.int64)])
        token = np.concatenate(out_token + [np.array([self.special[words[k][1:]] for k in special], np.int64)])
        order = np.argsort(word, kind="stable")
        return token[order].astype(np.int32), np.bincount(word, minlength=len(words)), len(todo)


class Memory:
    """Encoded words as rows of flat arrays, so a document's ids are one gather."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.clear()

    def clear(self) -> None:
        from collections import defaultdict
        from itertools import count

        import numpy as np

        self.index: dict[str, int] = defaultdict(count().__next__)  # a new word gets the next row
        self.ids = np.zeros(0, np.int32)
        self.lengths = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)

    def rows(self, words, total: int):
        """The row of each word; new words are encoded together."""
        from itertools import islice

        import numpy as np

        base = len(self.index)
        rows = np.fromiter(map(self.index.__getitem__, words), np.int64, total)
        fresh = list(islice(self.index, base, None))
        if fresh:
            flat, counts, _ = self.bpe.encode_words(fresh)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.lengths = np.concatenate([self.lengths, counts])
            self.ids = np.concatenate([self.ids, flat])
        return rows


def encode_texts(memory: Memory, texts: list[str]):
    """(flat int32 ids, ids per text) of a list of texts."""
    from itertools import chain

    import numpy as np

    if len(memory.index) > MAX_REMEMBERED:
        memory.clear()
    parts = [memory.bpe.words(t) for t in texts]
    n_words = np.fromiter(map(len, parts), np.int64, len(parts))
    rows = memory.rows(chain.from_iterable(parts), int(n_words.sum()))
    per_word = memory.lengths[rows]
    flat = ragged_take(memory.ids, memory.starts[rows], per_word)
    ends = np.concatenate([[0], np.cumsum(per_word)])[np.concatenate([[0], np.cumsum(n_words)])]
    return flat, np.diff(ends)


def bpe_encode(docs: DataFrame, tokenizer_path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>, decoded string) for every row: encoded, then decoded from the ids."""
    path = tokenizer_path or default_tokenizer()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        memory = None
        for batch in batches:
            if memory is None:
                memory = Memory(WordBpe(path))
                names = [memory.bpe.token.get(i, "") for i in range(max(memory.bpe.token) + 1)]
            texts = batch.column(1).to_pylist()
            first = 0
            while first < len(texts):
                size, n = 0, 0  # pieces of some MB, so that ids and decoded text stay small
                while first + n < len(texts) and (n == 0 or size + len(texts[first + n]) <= PIECE_CHARS):
                    size += len(texts[first + n])
                    n += 1
                step, first = (first, texts[first : first + n]), first + n
                flat, counts = encode_texts(memory, step[1])
                ends = np.concatenate([[0], np.cumsum(counts)])
                decoded = [" ".join([names[i] for i in flat[a:b].tolist()]) for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(step[0], n),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                        pa.array(decoded, pa.string()),
                    ],
                    names=[key, "ids", "decoded"],
                )

    src = docs.select(F.col(key), text_of(text).alias("text"))
    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"`{key}` {kind}, ids array<int>, decoded string")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(bpe_encode(table(spark, sf_dir, "documents", "doc_id", "text")))


def digest(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    return encoded.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
