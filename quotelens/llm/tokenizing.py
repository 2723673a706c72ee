"""Token ids and counts as the tokenizers library gives them, each distinct piece of text encoded once per worker.

Both vocabularies split text before they merge, and the split never crosses the
cuts made here, so pieces can be encoded on their own and their ids joined:

- `word_bpe` drops white space, so a space or line end always ends a piece; and a run of
  letters always ends before ASCII punctuation without apostrophe (NFC, case and
  the special strings do not reach across either).
- `byte_bpe` joins a space to what follows, so a piece ends between a character
  that is no white space and a space.

Whatever does not fit the simple cuts stays one longer piece.
"""

from __future__ import annotations

import os
import re
import sys

from quotelens.llm.common import give_back

MEMO = 400_000


def load(path: str):
    """The tokenizer of a file, loaded once in each worker process."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    held = sys.__dict__.setdefault("_quotelens_tokenizers", {})
    if path not in held:
        held[path] = (Tokenizer.from_file(path), {})
    return held[path]


def forget() -> None:
    """Drop the pieces that this worker remembers; for tasks of other work, which the memory is then there for."""
    for _, held in sys.__dict__.get("_quotelens_tokenizers", {}).values():
        for pieces in held.values():
            pieces.clear()
    give_back()


def encode_pieces(tokenizer, pieces: list[str]) -> list[list[int]]:
    fast = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    return [e.ids for e in fast(pieces, add_special_tokens=False)]


#: A piece that stands between others when they are encoded as one text.
SEPARATOR = "|"


def encode_joined(tokenizer, pieces: list[str]) -> list[bytes]:
    """Ids of pieces that white space always ends, as little-endian unsigned 32-bit integers.

    The pieces are encoded as one text, which saves what each call and each result
    costs, and its ids are parted at the separator's. Pieces that hold the separator,
    and all if its id does not occur just between them, are encoded on their own.
    """
    import numpy as np

    def alone(some):
        return [np.asarray(ids, dtype="<u4").tobytes() for ids in encode_pieces(tokenizer, some)]

    simple = [p for p in pieces if SEPARATOR not in p]
    mark, joined = encode_pieces(tokenizer, [SEPARATOR, f" {SEPARATOR} ".join(simple)])
    ids = np.asarray(joined, dtype="<u4")
    at = 4 * np.flatnonzero(ids == mark[0]) if len(mark) == 1 else ()
    if len(at) != len(simple) - 1:
        return alone(pieces)
    data = ids.tobytes()
    parts = iter([data[a:b] for a, b in zip([0, *(at + 4).tolist()], [*at.tolist(), len(data)])])
    others = iter(alone([p for p in pieces if SEPARATOR in p]))
    return [next(others) if SEPARATOR in p else next(parts) for p in pieces]


class Memo:
    """piece -> value for the pieces met; two generations, so that it stays bounded and keeps frequent pieces."""

    def __init__(self, encode, held: dict, size: int = MEMO):
        self.encode = encode
        self.held = held
        self.size = size
        self.held.setdefault("new", {})
        self.held.setdefault("old", {})

    def lookup(self, pieces: list[str]) -> list:
        """Values of all pieces, in order."""
        if len(self.held["new"]) > self.size // 2:
            self.held["old"], self.held["new"] = self.held["new"], {}
        new = self.held["new"]
        values = list(map(new.get, pieces))
        if None in values:
            old = self.held["old"]
            missing = []
            for p in {p for p, v in zip(pieces, values) if v is None}:
                v = old.get(p)
                if v is None:
                    missing.append(p)
                else:
                    new[p] = v
            for i in range(0, len(missing), 4096):
                part = missing[i : i + 4096]
                new.update(zip(part, self.encode(part)))
            values = list(map(new.get, pieces))
        return values


#: Letters of which lower case is one letter, and ASCII punctuation that always ends a run of them.
WORD_PIECES = re.compile(r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+(?=[.,!?;:*#$%&| \n])|[^ \n]+")
BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")


def word_id_bytes(path: str):
    """text -> its ids as little-endian unsigned 32-bit integers, for a word_bpe vocabulary."""
    tokenizer, held = load(path)

    def encode(pieces):
        import numpy as np

        return [np.asarray(ids, dtype="<u4").tobytes() for ids in encode_pieces(tokenizer, pieces)]

    memo = Memo(encode, held)
    find = WORD_PIECES.findall

    def ids(text: str) -> bytes:
        return b"".join(memo.lookup(find(text)))

    return ids


#: Bytes of text that are cut into pieces at a time, and pieces whose ids a worker remembers (about 200 bytes each).
CHUNK_BYTES, WORD_MEMO = 3_000_000, 400_000


def word_ids(path: str, end: int):
    """Texts (UTF-8, in a list) to arrays of their ids, each with the id `end` behind them, for a word_bpe vocabulary.

    The texts of a chunk are cut together, at the places WORD_PIECES cuts, and each
    distinct piece of the chunk is looked up once. A text longer than a chunk is cut
    at spaces, where pieces end anyway.
    """
    import numpy as np
    import pyarrow as pa

    tokenizer, held = load(path)

    memo = Memo(lambda pieces: encode_joined(tokenizer, pieces), held, WORD_MEMO)
    blank, stop, single = (np.zeros(256, bool) for _ in range(3))
    blank[list(b" \n")] = stop[list(b".,!?;:*#$%&|")] = True
    single[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True

    def pieces_of(data):
        """Starts and ends of all pieces."""
        gap = blank[data]
        starts = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1]))).astype(np.int32)
        ends = np.flatnonzero(~gap & np.concatenate((gap[1:], [True]))).astype(np.int32) + 1
        # Letters of two bytes are C3 and one of 80 to BF, but for the signs of multiplication and division.
        lead = np.concatenate(([False], data[:-1] == 0xC3))
        tail = lead & (data != 0x97) & (data != 0xB7)
        letter = single[data] | tail
        letter[:-1] |= tail[1:]
        other = np.concatenate((np.flatnonzero(~letter).astype(np.int32), np.array([len(data)], np.int32)))
        first = other[np.searchsorted(other, starts)]
        cut = (first > starts) & (first < ends)
        cut[cut] = stop[data[first[cut]]]
        starts = np.concatenate((starts, first[cut]))
        ends = np.concatenate((np.where(cut, first, ends), ends[cut]))
        order = np.argsort(starts, kind="stable")
        return starts[order], ends[order]

    def chunk_ids(texts):
        joined = b"\n".join(texts)
        data = np.frombuffer(joined, np.uint8)
        text_ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int32)
        if not len(data):
            return [np.array([end], "<u4") for _ in texts]
        starts, ends = pieces_of(data)
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        # Pieces hold everything but blanks.
        compact = data[~blank[data]]
        encoded = pa.Array.from_buffers(
            pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(compact)]
        ).dictionary_encode()
        values = memo.lookup(encoded.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(values), "<u4")
        # Places in a chunk fit 32 bits, as do its bytes.
        sizes = np.fromiter(map(len, values), np.int32, len(values)) // 4
        begins = np.cumsum(sizes, dtype=np.int32) - sizes
        codes = encoded.indices.to_numpy()
        n = sizes[codes]
        upto = np.concatenate((np.zeros(1, np.int32), np.cumsum(n, dtype=np.int32)))
        # Each text's ids lie as many places further as texts end before it.
        owner = np.searchsorted(text_ends, starts, side="right").astype(np.int32)
        found = np.full(upto[-1] + len(texts), end, "<u4")
        line = np.arange(upto[-1], dtype=np.int32)
        place = np.repeat(owner, n) + line
        line += np.repeat(begins[codes] - upto[:-1], n)
        found[place] = flat[line]
        borders = upto[np.searchsorted(owner, np.arange(1, len(texts)))] + np.arange(1, len(texts))
        return np.split(found, borders)

    def long_ids(text):
        parts, at = [], 0
        while at < len(text):
            to = len(text) if len(text) - at <= CHUNK_BYTES else text.find(b" ", at + CHUNK_BYTES)
            to = len(text) if to < 0 else to
            parts.append(chunk_ids([text[at:to]])[0][:-1])
            at = to
        return np.concatenate([*parts, np.array([end], "<u4")])

    def run(texts):
        waiting, size = [], 0
        for text in texts:
            text = text or b""
            if waiting and size + len(text) > CHUNK_BYTES:
                yield from chunk_ids(waiting)
                waiting, size = [], 0
            if len(text) > CHUNK_BYTES:
                yield long_ids(text)
                continue
            waiting.append(text)
            size += len(text) + 1
        if waiting:
            yield from chunk_ids(waiting)

    return run


def byte_counts(path: str):
    """text -> its number of tokens, for a byte_bpe vocabulary."""
    tokenizer, held = load(path)
    memo = Memo(lambda pieces: [len(ids) for ids in encode_pieces(tokenizer, pieces)], held)

    def count(text: str) -> int:
        if not text:
            return 0
        return sum(memo.lookup(BEFORE_SPACE.split(text)))

    return count
