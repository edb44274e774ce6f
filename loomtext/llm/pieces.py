"""SentencePiece encoding and decoding by best total score.

An Aho-Corasick automaton over the pieces reports, at each position, every piece that ends there (its output links); a
single-pass Viterbi relaxes the best score of each end.  Characters that no piece covers take byte pieces.  The text is
prepared as the model's normaliser does (a leading space, spaces become ``\\u2581``), and no piece has that mark after
another character, so the best path of a text is the best paths of its space-delimited stretches side by side; these
are remembered up to a bounded number.

A literal ``\\u2581`` takes byte pieces, so decoding returns each text exactly.  Scores are the model's; for a model
trained by merges they rank merges, so the segmentation is the best by score and need not be the merge order's.

Of pieces that end at the same place with the same best score the longest is taken.

Edge cases: a null text encodes as null and decodes as null; an empty text as no ids; very long texts are cut at their spaces,
and what has none is walked as one stretch; repeated rows and extra columns are kept, whatever their names: only columns
called ``piece_ids`` or ``piece_text`` are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import with_columns

MARK = "▁"
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_COST = -1e12  # for each byte: worse than any piece
_WITH_BYTES = BYTE_COST / 2
_LOW = float("-inf")
REMEMBER = 100_000


def load(path: str = TOKENIZER) -> list[tuple[str, float, str]]:
    """(piece, score, kind) by id; kind: normal, byte or control. Read on the driver; 32,000 pieces are about 1 MB."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    kinds = ["byte" if sp.is_byte(i) else "control" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else "normal" for i in range(sp.get_piece_size())]
    return [(sp.id_to_piece(i), sp.get_score(i), kinds[i]) for i in range(sp.get_piece_size())]


def _chunks(normal: list[str]):
    """A function that cuts prepared text where no piece reaches across: before a mark that follows another character,
    before the punctuation that no piece has after a letter, and around characters that no piece has."""
    ascii_signs = [c for c in map(chr, range(128)) if not c.isalnum()]
    held = set("".join(normal))
    alone = {c for c in ascii_signs if c not in held}
    before = {c for c in ascii_signs if c in held}
    while joined := {b for p in normal for a, b in zip(p, p[1:]) if b in before and a not in before and a != MARK}:
        before -= joined
    one, cut = ("".join(map(re.escape, sorted(x))) for x in (alone, before))
    first = f"[{one}]|" if one else ""
    signs = f"[{cut}]" if cut else "(?!)"
    return re.compile(f"{first}{MARK}*{signs}*[^{MARK}{cut}{one}]+|{MARK}*{signs}+|{MARK}+").findall


class Automaton:
    """Aho-Corasick over the pieces, as arrays. Node 0 is the root."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        normal = [(p, score, i) for i, (p, score, kind) in enumerate(pieces) if kind == "normal"]
        codes = sorted(set(map(ord, "".join(p for p, _, _ in normal))))
        self.codes = np.array(codes, np.int32)
        number = {c: k + 1 for k, c in enumerate(codes)}
        self.width = len(codes) + 1
        children: list[dict[int, int]] = [{}]
        depth, piece, score = [0], [-1], [0.0]
        for p, value, i in normal:
            node = 0
            for c in map(number.__getitem__, map(ord, p)):
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    depth.append(depth[node] + 1)
                    piece.append(-1)
                    score.append(0.0)
                node = children[node][c]
            piece[node], score[node] = i, value
        fail, link, queue = [0] * len(children), [0] * len(children), list(children[0].values())
        for node in queue:
            for c, child in children[node].items():
                f = fail[node]
                while f and c not in children[f]:
                    f = fail[f]
                fail[child] = children[f].get(c, 0)
                queue.append(child)
            link[node] = fail[node] if piece[fail[node]] >= 0 else link[fail[node]]
        edges = sorted((node * self.width + c, child) for node, kids in enumerate(children) for c, child in kids.items())
        self.keys, self.to = np.array([k for k, _ in edges], np.int64), np.array([x for _, x in edges], np.int32)
        self.fail, self.link, self.depth, self.piece, self.score = np.array(fail, np.int32), np.array(link, np.int32), np.array(depth, np.int32), np.array(piece, np.int32), np.array(score)

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Where each node goes on each character, by way of its fail links."""
        out = nodes.astype(np.int64)
        left = np.arange(len(out))
        while len(left):
            key = out[left] * self.width + chars[left]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            out[left[hit]] = self.to[at[hit]]
            left = left[~hit]
            root = out[left] == 0
            left = left[~root]
            out[left] = self.fail[out[left]]
        return out


CELLS = 400_000


class Codec:
    def __init__(self, pieces: list[tuple[str, float, str]]):
        self.byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == "byte"}
        self.text = [p.replace(MARK, " ").encode() if kind == "normal" else bytes([int(p[3:5], 16)]) if kind == "byte" else b"" for p, _, kind in pieces]
        normal = [p for p, _, kind in pieces if kind == "normal"]
        if MARK not in normal or len(self.byte) < 256:
            raise ValueError("the model must have the piece \u2581 and all byte pieces")
        self.length = np.array([len(p) for p, _, _ in pieces], np.int64)
        self.automaton = Automaton(pieces)
        self.chunks = _chunks(normal)
        self.mark = np.array([self.byte[b] for b in MARK.encode()], np.int32).tobytes()
        self.known: dict[str, bytes] = {}

    def _learn(self, chunks: list[str]) -> None:
        """Fills known for new chunks; those of like length go through the automaton side by side."""
        chunks.sort(key=len, reverse=True)
        at = 0
        while at < len(chunks):
            n = max(1, CELLS // (len(chunks[at]) + 1))
            self._viterbi(chunks[at : at + n])
            at += n

    def _viterbi(self, chunks: list[str]) -> None:
        a = self.automaton
        sizes = np.array([len(c) for c in chunks])
        longest, wide = int(sizes[0]), len(chunks)
        code = np.zeros((longest, wide), np.int32)
        flat = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32)
        lane = np.repeat(np.arange(wide), sizes)
        code[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), lane] = flat
        place = np.minimum(np.searchsorted(a.codes, code), len(a.codes) - 1)
        char = np.where(a.codes[place] == code, place + 1, 0)
        spelled = BYTE_COST * (1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))
        best = np.full((longest + 1, wide), _LOW)
        back = np.full((longest + 1, wide), -1, np.int32)
        best[0] = 0
        node = np.zeros(wide, np.int64)
        for end in range(1, longest + 1):
            live = int(np.searchsorted(-sizes, -end, side="right"))  # lanes go from long to short
            node = a.step(node[:live], char[end - 1, :live])
            out = np.where(a.piece[node] >= 0, node, a.link[node])
            lanes = np.flatnonzero(out)
            out = out[lanes]
            while len(lanes):
                value = best[end - a.depth[out], lanes] + a.score[out]
                better = value > best[end, lanes]
                best[end, lanes[better]] = value[better]
                back[end, lanes[better]] = a.piece[out[better]]
                out = a.link[out]
                more = out > 0
                lanes, out = lanes[more], out[more]
            poor = np.flatnonzero(best[end, :live] < _WITH_BYTES)
            if len(poor):
                value = best[end - 1, poor] + spelled[end - 1, poor]
                better = value > best[end, poor]
                best[end, poor[better]] = value[better]
                back[end, poor[better]] = -1
        length = self.length
        at, lanes, steps = sizes.copy(), np.arange(wide), []
        while len(lanes):
            ids = back[at[lanes], lanes]
            steps.append((lanes, ids, at[lanes]))
            at[lanes] -= np.where(ids >= 0, length[ids], 1)
            lanes = lanes[at[lanes] > 0]
        lane, ids, where = (np.concatenate(x)[::-1] for x in zip(*steps))
        order = np.argsort(lane, kind="stable")
        lane, ids, where = lane[order], ids[order], where[order]
        first = np.searchsorted(lane, np.arange(wide + 1)).tolist()
        raw, spelt = ids.astype(np.int32).tobytes(), np.zeros(wide, bool)
        spelt[lane[ids < 0]] = True
        spelt = spelt.tolist()
        for k, chunk in enumerate(chunks):
            i, j = first[k], first[k + 1]
            if spelt[k]:
                out: list[int] = []
                for x, w in zip(ids[i:j].tolist(), where[i:j].tolist()):
                    out.extend([x] if x >= 0 else [self.byte[b] for b in chunk[w - 1].encode()])
                self.known[chunk] = np.array(out, np.int32).tobytes()
            else:
                self.known[chunk] = raw[4 * i : 4 * j]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian int32."""
        parts: list[list[str]] = []
        for text in texts:
            own: list[str] = []
            for k, part in enumerate(text.split(MARK) if text else ()):
                if k:
                    own.append("")  # a mark in the text itself
                if part or not k:
                    own += self.chunks((MARK if not k else "") + part.replace(" ", MARK))
            parts.append(own)
        self.known[""] = self.mark
        new = {c for own in parts for c in own if c not in self.known}
        self._learn(list(new))
        get = self.known.__getitem__
        out = [b"".join(map(get, own)) for own in parts]
        if len(self.known) > REMEMBER:
            self.known.clear()
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_batch([text])[0], "<i4").tolist()

    def decode(self, ids) -> str:
        table = self.text
        raw = b"".join([table[i] for i in ids])
        return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


def _lists(ids: list[bytes], texts: list[str | None]) -> pa.ListArray:
    """array<int> of packed ids; null where the text is null."""
    offsets = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
    raw = b"".join(ids)
    values = pa.Array.from_buffers(pa.int32(), len(raw) // 4, [None, pa.py_buffer(raw)])
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array([t is None for t in texts], pa.bool_()))


def _coded(docs: DataFrame, pieces: list[tuple[str, float, str]], back: bool) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(Codec(pieces))
    new = "piece_ids array<int>" + ", piece_text string" * back
    at = [c.lower() for c in docs.drop("piece_ids", *["piece_text"] * back).columns].index("text")

    def start():
        codec = sent.value

        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = batch.column(at).to_pylist()
            ids = codec.encode_batch([t or "" for t in texts])
            if not back:
                return [_lists(ids, texts)]
            decoded = [None if t is None else codec.decode(np.frombuffer(x, "<i4").tolist()) for t, x in zip(texts, ids)]
            return [_lists(ids, texts), pa.array(decoded, pa.string())]

        return make

    return with_columns(docs, new, start, part=256)


def encode(docs: DataFrame, pieces: list[tuple[str, float, str]]) -> DataFrame:
    """Adds piece_ids array<int> to docs(text, ...)."""
    return _coded(docs, pieces, False)


def encode_and_decode(docs: DataFrame, pieces: list[tuple[str, float, str]]) -> DataFrame:
    """Adds piece_ids and what they decode to, piece_text, in one pass: one Python worker a task, not two."""
    return _coded(docs, pieces, True)


def decode(encoded: DataFrame, pieces: list[tuple[str, float, str]]) -> DataFrame:
    """Adds piece_text string to encoded(piece_ids, ...)."""
    sent = encoded.sparkSession.sparkContext.broadcast(Codec(pieces))
    at = [c.lower() for c in encoded.drop("piece_text").columns].index("piece_ids")

    def start():
        codec = sent.value
        return lambda batch: [pa.array([None if not x.is_valid else codec.decode(x.values.to_numpy(zero_copy_only=False).tolist()) for x in batch.column(at)], pa.string())]

    return with_columns(encoded, "piece_text string", start)
