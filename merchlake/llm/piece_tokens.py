"""Exact SentencePiece (merge type) encoding by backtracking, and decoding.

Merge-type encoding joins the best-ranked neighbours again and again.  The
same result comes from left to right: take the longest vocabulary piece that
starts here (Aho-Corasick finds all pieces of a word in one pass), keep it if
it is compatible with the piece before it, that is if merging the two pieces'
characters afresh gives these two pieces again, else try the next shorter
one; where none is left, step back over the last piece.  A bitfield marks
positions from which no way leads on, so no position is tried twice.

No piece has a space mark after another character, so a text falls apart
before each run of spaces; words repeat and are looked up.
"""

from __future__ import annotations

import hashlib
import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Recent, map_batches

MARK = "▁"
_RUNS = re.compile("▁*[^▁]+|▁+")


class PieceTokens:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i)}
        self.byte_ids = [0] * 256
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.raw: list[bytes] = [b""] * size
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.raw[i] = bytes([int(piece[1:-1], 16)])
            elif i not in self.special and not model.is_unused(i):
                self.rank[piece] = model.get_score(i)
                self.id[piece] = i
                self.raw[i] = piece.replace(MARK, " ").encode()
        self.most = max(map(len, self.id))
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("the vocabulary has pieces that cross a word's start")
        self.pairs = Recent(self._compatible, 250_000)
        self.words = Recent(self._word, 200_000)
        self.told = Recent(self._tell, 250_000)
        self.find = ahocorasick.Automaton()
        self.candidates = {p for p in self.id if len(p) == 1 or self.merge(p) == [p]}  # merging never makes the others
        for piece in self.candidates:
            self.find.add_word(piece, len(piece))
        self.find.make_automaton()

    def merge(self, text: str) -> list[str]:
        """The definition: merge the best-ranked pair, the leftmost among equals, until none is left.

        Pairs wait in a heap, so the time is n log n; a pair whose parts have
        changed since is passed over.
        """
        n, rank, most = len(text), self.rank.get, self.most
        end = list(range(1, n + 1))  # of the part that starts here; 0: none does
        start = list(range(-1, n))  # of the part that ends here
        heap = [(-r, i, i + 2) for i in range(n - 1) if (r := rank(text[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, e = heappop(heap)
            j = end[i]
            if not j or j == n or end[j] != e:
                continue
            end[i], end[j], start[e] = e, 0, i
            if i and e - (h := start[i]) <= most and (r := rank(text[h:e])) is not None:
                heappush(heap, (-r, h, e))
            if e < n and (f := end[e]) - i <= most and (r := rank(text[i:f])) is not None:
                heappush(heap, (-r, i, f))
        return [text[i:e] for i, e in enumerate(end) if e]

    def _compatible(self, pair: tuple[str, str]) -> bool:
        return self.merge(pair[0] + pair[1]) == [*pair]

    def backtrack(self, word: str) -> list[str] | None:
        """The pieces of a word; None if it has a character that is no piece, or no chain of compatible pieces exists."""
        n, pairs = len(word), self.pairs
        ends = [end + 1 for end, _ in self.find.iter_long(word)]
        # the longest matches, each from where the last one ends; often they are compatible as they are
        out: list[str] = []
        p = 0
        for q in ends:
            piece = word[p:q]
            if piece not in self.id:
                return None
            if out and not pairs[out[-1], piece]:
                break
            out.append(piece)
            p = q
        if p == n:
            return out
        failed = bytearray(n // 8 + 1)  # bit p: no way leads on from position p
        top = p + self._longest(word, p)
        while p < n:
            q = top
            while q > p:
                piece = word[p:q]
                if piece in self.candidates and not failed[q >> 3] >> (q & 7) & 1 and (not out or pairs[out[-1], piece]):
                    break
                q -= 1
            if q > p:
                out.append(piece)
                p = q
                top = p + self._longest(word, p)
            else:
                failed[p >> 3] |= 1 << (p & 7)
                if not out:
                    return None
                top = p - 1
                p -= len(out.pop())
        return out

    def _longest(self, word: str, at: int) -> int:
        """No piece that starts here is longer."""
        return self.find.longest_prefix(word[at : at + self.most])

    def _word(self, word: str) -> tuple[int, ...]:
        """Ids of a run of space marks and the characters after it."""
        # equal ranks (runs of marks) leave it open which merge comes first: there the definition decides
        pieces = None if word.startswith(MARK * 2) else self.backtrack(word)
        if pieces is not None:
            return tuple(map(self.id.__getitem__, pieces))
        ids: list[int] = []
        known, start = self.id, 0
        for stop in [*(i for i, c in enumerate(word) if c not in known), len(word)]:
            if stop > start:
                part = word[start:stop]
                pieces = self.merge(part) if part.startswith(MARK * 2) else self.backtrack(part) or self.merge(part)
                ids += [known[x] for x in pieces]
            if stop < len(word):
                ids += [self.byte_ids[b] for b in word[stop].encode()]
            start = stop + 1
        return tuple(ids)

    def _tell(self, word: str) -> tuple[int, str, bytes]:
        """How many ids a word has, their decimals joined by commas, the bytes they stand for."""
        ids = self._word(word)
        return len(ids), ",".join(map(str, ids)), b"".join(map(self.raw.__getitem__, ids))

    def _split(self, text: str) -> list[str]:
        """A text's words with the space marks before them; line feeds, which no piece holds, stand alone."""
        if "  " in text or text[0] == " " or text[-1] == " " or MARK in text or "\x00" in text or "\n" in self.id:
            return _RUNS.findall(MARK + text.replace(" ", MARK))
        words = (MARK + text.replace(" ", "\x00" + MARK)).replace("\n", "\x00\n\x00")
        return [w for w in words.split("\x00") if w]

    def encode(self, text: str | None) -> list[int]:
        return [i for ids in map(self.words.__getitem__, self._split(text)) for i in ids] if text else []

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, marks as spaces, without the space that encoding put first."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        return (raw[1:] if ids and raw[:1] == b" " else raw).decode("utf-8", "replace")

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """How many ids a text has, the SHA-256 of their decimals joined by commas, and of what they decode to."""
        found = list(map(self.told.__getitem__, self._split(text))) if text else []
        raw = b"".join([x[2] for x in found])
        raw = (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace").encode()
        return sum([x[0] for x in found]), hashlib.sha256(",".join([x[1] for x in found]).encode()).hexdigest(), hashlib.sha256(raw).hexdigest()


_made: dict[str, PieceTokens] = {}


def piece_tokens(path: str) -> PieceTokens:
    if path not in _made:
        _made[path] = PieceTokens(path)
    return _made[path]


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (array of int), decoded (the text that the ids give back) for every row.

    A null or empty text has no ids and decodes to the empty string.
    """

    def run(c: dict) -> pa.RecordBatch:
        enc = piece_tokens(model_path)
        ids = [enc.encode(t) for t in c["text"].to_pylist()]
        return pa.RecordBatch.from_arrays([c["doc_id"].cast(pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array([enc.decode(x) for x in ids], pa.string())], ["doc_id", "ids", "decoded"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """As ``encode``, with SHA-256 digests in place of the ids and the decoded text, made where the text is.

    n_tokens counts all ids; ids_sha256 is of the decimal ids joined by commas.
    """

    def run(c: dict) -> pa.RecordBatch:
        enc = piece_tokens(model_path)
        found = [enc.digest(t) for t in c["text"].to_pylist()]
        n, ids_sha, text_sha = ([x[i] for x in found] for i in range(3))
        return pa.RecordBatch.from_arrays([c["doc_id"].cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

