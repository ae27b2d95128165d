"""Byte-level BPE by recursive queries: each Arrow batch's new words are merged in DuckDB, ids decoded there too.

Vocabulary. A ``.tiktoken`` file of (base64 bytes, rank). From it each worker builds two tables: token
(id, bytes in hex) and merges (left id, right id -> id of the joined token; all ways to cut a token in two).

Encoding. Texts are cut into words by the pre-token pattern. A word that is a token is that token. All
others start as rows (word, position, token of one byte, next position and its token). The recursive
step joins the rows with the merges, takes each word's pair of least rank, the leftmost of these, and
contracts it; a word without a pair is at its fixpoint and leaves the recursion. A query holds the rows
of all its steps, so words are dealt to queries by the square of their length, and a word longer than
that allows goes through several queries, each taking up where the last one stopped. Time grows with the
square of a word's length; words are what lies between spaces, however long the text is.

Decoding. The ids of a batch, numbered in order, are joined with the token table; an ordered aggregation
per document gives its bytes.

Workers keep words they have met, in bounded caches. Rows are independent and nothing is shuffled: a lost
task is simply run again. Text None counts as empty (no ids, no bytes); repeated rows get the same
values, null ids stay, an empty table gives an empty result, columns other than doc_id and text are
ignored. Of equally ranked pairs the leftmost goes first.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator, Sequence
from hashlib import sha256
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import begin
from .pieces import CUT, OTHER

#: The pre-token pattern with the white space of Unicode, which is what the library's ``\\s`` stands for.
WHITE = r"\p{White_Space}"
#: Rows that one recursive query may hold, all steps together, and words in it.
QUERY_ROWS, QUERY_WORDS = 3_000_000, 60_000
#: Entries of a generation of a worker's cache.
HELD = 700_000

MERGE = """
WITH RECURSIVE s(word, pos, tok, nx, nt, step) AS (
  SELECT word, pos, tok, nx, nt, 0 FROM start
  UNION ALL
  SELECT s.word, s.pos, CASE WHEN s.pos = b.at THEN b.id ELSE s.tok END,
         CASE WHEN s.pos = b.at THEN c.nx ELSE s.nx END,
         CASE WHEN s.pos = b.at THEN c.nt WHEN s.nx = b.at THEN b.id ELSE s.nt END, s.step + 1
  FROM s
  JOIN (SELECT word, (min(k) & 4294967295)::INT AS at, (min(k) >> 32)::INT AS id, arg_min(nx, k) AS gone
        FROM (SELECT s.word, s.nx, (m.id::BIGINT << 32) + s.pos AS k
              FROM s JOIN merges m ON m.pair = (s.tok::BIGINT << 32) + s.nt WHERE s.step < $steps)
        GROUP BY word) b ON b.word = s.word
  JOIN s c ON c.word = b.word AND c.pos = b.gone
  WHERE s.pos <> b.gone)
SELECT word, pos, tok, step FROM s JOIN (SELECT word, max(step) AS last FROM s GROUP BY word) USING (word) WHERE step = last ORDER BY word, pos
"""

DECODE = """
SELECT doc, unhex(array_to_string(list(hex ORDER BY pos), '')) AS bytes FROM ids JOIN token ON token.id = ids.tok GROUP BY doc
"""


def pattern_of(source: str) -> regex.Pattern:
    return regex.compile(source.replace(r"(?!\S)", rf"(?!{WHITE.replace('p', 'P', 1)})").replace(r"\s", WHITE))


class Bpe:
    """Encoder and decoder of one vocabulary, with the tables of a DuckDB database in memory."""

    def __init__(self, path: str, pattern: str, memory: str = "400MB", held: int = HELD):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.split, self.vocab, self.held = pattern_of(pattern).findall, ranks, held
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": memory, "temp_directory": ""})
        token = pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [k.hex().upper() for k in ranks]})
        self.db.register("given", token)
        self.db.execute("CREATE TABLE token AS SELECT * FROM given")
        self.db.execute("""
            CREATE TABLE merges AS SELECT (l.id::BIGINT << 32) + r.id AS pair, t.id
            FROM (SELECT id, hex, unnest(range(2, length(hex), 2)) AS cut FROM token) t
            JOIN token l ON l.hex = left(t.hex, t.cut) JOIN token r ON r.hex = substr(t.hex, t.cut + 1)""")
        self.db.unregister("given")

    def _start(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words), dtype=np.int32), n)
        pos = (np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
        return word, pos, self.bytes[np.frombuffer(b"".join(words), np.uint8)]

    def _contract(self, words: Sequence[bytes]) -> list[bytes]:
        """The ids of words, all of at least one byte, as little-endian 32-bit integers."""
        out = [b""] * len(words)
        word, pos, tok = self._start(words)
        while len(word):
            steps = max(1, QUERY_ROWS // len(word))
            last = np.append(word[1:] != word[:-1], True)
            start = pa.table({"word": word, "pos": pos, "tok": tok, "nx": pa.array(np.append(pos[1:], 0).astype(np.int32), mask=last),
                              "nt": pa.array(np.append(tok[1:], 0).astype(np.int32), mask=last)})
            self.db.register("start", start)
            got = self.db.execute(MERGE, {"steps": steps}).fetchnumpy()
            self.db.unregister("start")
            word, pos, tok, step = (np.asarray(got[c]) for c in ("word", "pos", "tok", "step"))
            done = step < steps
            ids, flat = word[done], tok[done].astype("<u4").tobytes()
            if len(ids):
                first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
                ends = [*(first[1:] * 4).tolist(), len(flat)]
                for w, at, to in zip(ids[first].tolist(), (first * 4).tolist(), ends, strict=True):
                    out[w] = flat[at:to]
            word, pos, tok = word[~done], pos[~done], tok[~done]
        return out

    def _learn(self, words: Iterable[str]) -> None:
        """Keep the ids of words not met before."""
        new, rows = [], 0
        for size, w, b in sorted((len(b), w, b) for w, b in ((w, w.encode()) for w in words)):
            if b in self.vocab:
                self._keep(w, self.vocab[b].to_bytes(4, "little"))
                continue
            if new and (rows + size * size // 2 > QUERY_ROWS or len(new) >= QUERY_WORDS):
                self._take(new)
                new, rows = [], 0
            new.append((w, b))
            rows += size * size // 2
        if new:
            self._take(new)

    def _take(self, new: list[tuple[str, bytes]]) -> None:
        for (w, _), ids in zip(new, self._contract([b for _, b in new]), strict=True):
            self._keep(w, ids)

    def _keep(self, w: str, ids: bytes) -> None:
        if w[0] == " " and w[1:].strip():
            self.pieces[w[1:]] = ids
        else:
            self.words[w] = ids

    def _missing(self, pieces: Iterable[str]) -> set[str]:
        """Those not held; what only the older generation holds moves to the younger."""
        new = set(pieces).difference(self.pieces)
        if self.older:
            found = new.intersection(self.older)
            self.pieces.update((p, self.older[p]) for p in found)
            new -= found
        return new

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers.

        A word never reaches over a space that stands before a visible character, so texts are cut there
        first and what lies between is looked up whole. A word that opens with a space is kept as the piece
        after it. Of two generations of pieces the older is given up once the younger is full; what is
        still used moves on.
        """
        if len(self.pieces) > self.held:
            self.older, self.pieces = self.pieces, {}
        if len(self.words) > self.held:
            self.words = {}
        cut = [CUT.split(t) if OTHER.search(t) else t.split(" ") for t in texts]
        # a text's head opens without a space, unlike the pieces after it
        heads = [c[0] for c in cut]
        for c in cut:
            del c[0]
        built = [(p, " " + p) for p in self._missing(chain.from_iterable(cut))]
        built = [(p, self.split(w)) for p, w in built]
        first = {h: self.split(h) for h in set(heads)}
        several = [ws for _, ws in built if len(ws) > 1]
        inner = set(chain(*several, *first.values()))
        after = self._missing({w[1:] for w in inner if w[0] == " " and w[1:].strip()})
        self._learn({*(ws[0] for _, ws in built if len(ws) == 1), *(" " + p for p in after),
                     *(w for w in inner if not (w[0] == " " and w[1:].strip()) and w not in self.words)})

        def joined(ws: list[str]) -> bytes:
            return b"".join([self.pieces[w[1:]] if w[0] == " " and w[1:].strip() else self.words[w] for w in ws])

        self.pieces.update((p, joined(ws)) for p, ws in built if len(ws) > 1)
        first = {h: joined(ws) for h, ws in first.items()}
        known = self.pieces.__getitem__
        return [first[h] + b"".join(map(known, c)) for h, c in zip(heads, cut, strict=True)]

    def decode(self, encoded: Sequence[bytes]) -> list[bytes]:
        """The bytes that ids stand for."""
        tok = np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)
        doc = np.repeat(np.arange(len(encoded), dtype=np.int32), [len(e) // 4 for e in encoded])
        out = [b""] * len(encoded)
        if len(tok):
            self.db.register("ids", pa.table({"doc": doc, "pos": np.arange(len(tok), dtype=np.int32), "tok": tok}))
            for d, b in self.db.execute(DECODE).fetchall():
                out[d] = b
            self.db.unregister("ids")
        return out


_LOADED: dict[tuple[str, str], Bpe] = {}


def worker_bpe(path: str, pattern: str) -> Bpe:
    """One per worker process; later tasks find its tables and caches."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Bpe(path, pattern)
    return _LOADED[path, pattern]


#: Characters of text that are worked on at once.
SLICE = 2 << 20


def slices(rows: Iterable[tuple], size: int) -> Iterator[list[tuple]]:
    """Rows, whose second item is a text, in lists that stay below ``size`` characters, one row at least."""
    held, length = [], 0
    for row in rows:
        if held and length + len(row[1]) > size:
            yield held
            held, length = [], 0
        held.append(row)
        length += len(row[1])
    if held:
        yield held


def _coded(docs: DataFrame, path: str, pattern: str, names: str, values: Callable[[list[bytes], list[bytes]], list[pa.Array]]) -> DataFrame:
    """doc_id and ``values`` of (ids, decoded bytes) for each row of docs."""
    begin(docs.sparkSession)

    def run(batches):
        bpe = worker_bpe(path, pattern)
        rows = ((i, t or "") for batch in batches for i, t in zip(batch.column(0), batch.column(1).to_pylist(), strict=True))
        for part in slices(rows, SLICE):
            ids = bpe.encode([t for _, t in part])
            yield pa.RecordBatch.from_arrays(
                [pa.array([i.as_py() for i, _ in part], part[0][0].type), *values(ids, bpe.decode(ids))], ["doc_id", *columns])

    columns = [c.split()[0] for c in names.split(", ")]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {names}")


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array of long), decoded (binary) for each row of docs."""
    def values(ids, decoded):
        return [pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in ids], pa.list_(pa.int64())), pa.array(decoded, pa.binary())]

    return _coded(docs, path, pattern, "ids array<long>, decoded binary", values)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row of docs; ids and bytes stay in the task."""
    def values(ids, decoded):
        return [pa.array([len(x) // 4 for x in ids], pa.int64()),
                *(pa.array([sha256(x).hexdigest() for x in part], pa.string()) for part in (ids, decoded))]

    return _coded(docs, path, pattern, "n_tokens long, ids_sha256 string, decoded_sha256 string", values)
