"""Secret scans: patterns, and encodings confirmed by decoding them and checking their structure."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.llm.common import give_back, in_slices
from quotelens.llm.tokenizing import forget

#: Order of kinds among spans that start together. The first three are plain patterns.
KINDS = ("assign", "access", "hex", "token", "key")


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = re.compile(
    "(" + "|".join(map(_either_case, KEYWORDS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Of the keywords in lower case, what a text must hold for ASSIGN to match.
KEYWORD_PARTS = (b"passw", b"secret", b"token", b"api")
#: Characters of which every other match is made, and the fewest in a row.
RUN_CHARACTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
RUN = 20

#: A token, or its first parts, may stand behind a line end written as backslash and letter.
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(?:(?<=\\)[nrt])?([A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]+)")
#: Where a key may begin: the first letters of a DER sequence or of an OpenSSH key, in a line of 32 letters or more.
KEY_START = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\n))(?=[A-Za-z0-9+/]{32})(?:M[A-P]|b3BlbnNzaC1rZXktdjEA)")
LETTERS = re.compile(r"[A-Za-z0-9+/]+")
#: Line ends within a key, as such or written out once or twice escaped, and the indent of the next line.
LINE_END = re.compile(r"(?:\r?\n|(?:\\{1,2}r)?\\{1,2}n)[ \t]*")
HEX_BYTES = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{48,}")

#: Fixed values of the formats: bytes of a signature by algorithm, first bytes of an OpenSSH key.
SIGNATURE_BYTES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}
RSA_ALGORITHMS = ("RS256", "RS384", "RS512", "PS256", "PS384", "PS512")
OPENSSH = b"openssh-key-v1\x00"


def url_decoded(part: str) -> bytes | None:
    try:
        return base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))
    except (binascii.Error, ValueError):
        return None


def json_object(data: bytes | None) -> dict | None:
    try:
        found = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    """A header that names an algorithm, a payload that is an object, a signature of that algorithm's length."""
    head = json_object(url_decoded(header))
    if head is None or json_object(url_decoded(payload)) is None:
        return False
    signed, algorithm = url_decoded(signature), head.get("alg")
    if signed is None or not isinstance(algorithm, str):
        return False
    if algorithm in RSA_ALGORITHMS:
        return len(signed) >= 128 and len(signed) % 64 == 0
    return SIGNATURE_BYTES.get(algorithm) == len(signed)


def der_item(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the contents of the item at `at`, if it fits."""
    if at + 2 > end:
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or start + n > end:
            return None
        size, start = int.from_bytes(data[start : start + n], "big"), start + n
        if size < 0x80:
            return None  # DER has the shortest form only
    return (tag, start, start + size) if start + size <= end else None


def der_items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """Items that fill start to end exactly."""
    items = []
    while start < end:
        item = der_item(data, start, end)
        if item is None:
            return None
        items.append(item)
        start = item[2]
    return items


def is_private_key(data: bytes) -> bool:
    """Nested lengths and members of a private key: RSA, EC, PKCS #8 plain or encrypted, OpenSSH."""
    if data.startswith(OPENSSH):
        return openssh_size(data) == len(data)
    outer = der_item(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    items = der_items(data, outer[1], outer[2])
    if not items:
        return False
    tags = [tag for tag, _, _ in items]
    first = data[items[0][1] : items[0][2]]

    def algorithm(item) -> bool:
        inner = der_items(data, item[1], item[2])
        return bool(inner) and inner[0][0] == 0x06

    if tags[:1] == [0x02] and first in (b"\x00", b"\x01"):
        if tags == [0x02] * 9 or tags == [0x02] * 6:  # RSA, DSA
            return first == b"\x00" and items[1][2] - items[1][1] >= 32
        if tags[:2] == [0x02, 0x04] and first == b"\x01":  # EC
            return items[1][2] - items[1][1] in (16, 20, 24, 28, 32, 48, 66) and set(tags[2:]) <= {0xA0, 0xA1}
        if tags[:3] == [0x02, 0x30, 0x04]:  # PKCS #8
            return algorithm(items[1]) and items[2][2] - items[2][1] >= 16 and set(tags[3:]) <= {0xA0, 0xA1, 0x80, 0x81}
    return tags == [0x30, 0x04] and algorithm(items[0]) and items[1][2] - items[1][1] >= 32  # encrypted PKCS #8


def openssh_size(data: bytes) -> int | None:
    """Bytes of the OpenSSH key that `data` begins with, if its members fit."""
    at = len(OPENSSH)

    def string() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        found, at = data[at + 4 : at + 4 + size], at + 4 + size
        return found

    names = [string(), string(), string()]
    if None in names or at + 4 > len(data):
        return None
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16 or any(string() is None for _ in range(keys)):
        return None
    private = string()
    return at if private and len(private) % 8 == 0 else None


def key_size(head: bytes) -> int | None:
    """Bytes of the encoding that begins with `head`, where its outer length tells."""
    if head.startswith(OPENSSH):
        return 0
    if len(head) < 6 or head[0] != 0x30:
        return None
    n = head[1] & 0x7F
    if head[1] < 0x80:
        return 2 + n
    return 2 + n + int.from_bytes(head[2 : 2 + n], "big") if 1 <= n <= 4 else None


class Lines:
    """Base64 letters from `start` on, over line ends for as long as lines follow; places of letters by their number."""

    def __init__(self, text: str, start: int):
        self.text = text
        self.begins: list[int] = []
        self.before = [0]
        at: int | None = start
        while at is not None and (m := LETTERS.match(text, at)):
            self.begins.append(m.start())
            self.before.append(self.before[-1] + m.end() - m.start())
            self.end = m.end()
            gap = LINE_END.match(text, m.end())
            at = gap.end() if gap else None

    def number(self, place: int) -> int:
        """How many letters stand before `place`, which is a letter's."""
        line = bisect_right(self.begins, place) - 1
        return self.before[line] + place - self.begins[line]

    def data(self, first: int, n: int) -> bytes:
        """What `n` letters from number `first` on encode; of a last odd letter nothing."""
        parts, line = [], bisect_right(self.before, first) - 1
        while n > 0 and line < len(self.begins):
            at = self.begins[line] + first - self.before[line]
            take = min(n, self.before[line + 1] - first)
            parts.append(self.text[at : at + take])
            first, n, line = first + take, n - take, line + 1
        body = "".join(parts)
        body = body[: len(body) - (len(body) % 4 == 1)]
        return base64.b64decode(body + "=" * (-len(body) % 4))

    def place_behind(self, number: int) -> int:
        line = bisect_left(self.before, number) - 1
        return self.begins[line] + number - self.before[line]


def base64_key(lines: Lines, start: int) -> int | None:
    """End of the private key whose base64 begins at `start`, as its lengths have it, padding included."""
    first = lines.number(start)
    there = lines.before[-1] - first
    size = key_size(lines.data(first, 32))
    if size == 0:  # The members of an OpenSSH key tell its length: read on until all are there.
        reach = 4096
        while (size := openssh_size(lines.data(first, min(reach, there)))) is None and reach < there:
            reach *= 4
    if size is None or (letters := -(-4 * size // 3)) > there or not is_private_key(lines.data(first, letters)[:size]):
        return None
    end = lines.place_behind(first + letters)
    for _ in range(-letters % 4):
        end += lines.text[end : end + 1] == "="
    return end


def base64_keys(text: str) -> Iterator[tuple[int, int]]:
    """Private keys in base64, with each line's start tried and the place behind each key found."""
    at, lines = 0, None
    while m := KEY_START.search(text, at):
        start = m.start()
        if lines is None or start >= lines.end:
            lines = Lines(text, start)
        end = base64_key(lines, start)
        while end:
            yield start, end
            start = end
            # Another key may follow at once, without a line end between.
            end = base64_key(lines, start) if start < lines.end and LETTERS.match(text, start) else None
        at = max(start, m.start() + 1)


def hex_keys(text: str) -> Iterator[tuple[int, int]]:
    """Private keys in hex digits, also where one follows another at once."""
    for m in HEX_BYTES.finditer(text):
        data = bytes.fromhex(m[0][: len(m[0]) // 2 * 2])
        at = 0
        while at < len(data):
            size = key_size(data[at : at + 32])
            size = openssh_size(data[at:]) if size == 0 else size
            if not size or not is_private_key(data[at : at + size]):
                break
            yield m.start() + 2 * at, m.start() + 2 * (at + size)
            at += size


def signed_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Signed tokens; behind parts that are none, the search goes on at the second of them."""
    at = 0
    while m := TOKEN.search(text, at):
        holds = is_signed_token(*m.groups())
        if holds:
            yield m.start(1), m.end()
        at = m.end() if holds else m.start(2)


def pattern_spans(text: str) -> list[tuple[int, int, str]]:
    spans = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return spans + [(*m.span(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= 24]


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Signed tokens and private keys whose structure holds."""
    spans = [(*s, "token") for s in signed_tokens(text)]
    spans += [(*s, "key") for s in base64_keys(text)]
    return spans + [(*s, "key") for s in hex_keys(text)]


def ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str = "[secret]") -> str:
    """The text with each run of overlapping spans replaced by the mark."""
    parts, at = [], 0
    for start, end, _ in ordered(spans):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def may_hold(column) -> list[bool]:
    """For each text of an Arrow binary array, whether any pattern can match: looked up in all its bytes at once."""
    import numpy as np

    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    flag = np.zeros(len(column), bool)
    if len(column) and offsets[-1] > offsets[0]:
        data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        table = np.zeros(256, bool)
        table[np.frombuffer(RUN_CHARACTERS, np.uint8)] = True
        breaks = np.concatenate(([-1], np.flatnonzero(~table[data]), [len(data)]))
        # A run over the border of two texts is flagged for both: looked at, not matched.
        long = np.flatnonzero(np.diff(breaks) > RUN)
        first = np.searchsorted(offsets - offsets[0], breaks[long] + 1, "right") - 1
        last = np.searchsorted(offsets - offsets[0], breaks[long + 1] - 1, "right") - 1
        for a, b in zip(first.tolist(), last.tolist()):
            flag[a : b + 1] = True
    return flag.tolist()


def found_in(column) -> Iterator[tuple[str, list, list]]:
    """(text, pattern spans, confirmed spans) of each value of an Arrow text array; null is empty."""
    import pyarrow as pa

    column = column.cast(pa.binary())
    for data, runs in zip(column.to_pylist(), may_hold(column)):
        lowered = (data or b"").lower()
        if not runs and not any(part in lowered for part in KEYWORD_PARTS):
            yield None, [], []
            continue
        text = (data or b"").decode("utf-8", "replace")
        yield text, pattern_spans(text), confirmed_spans(text) if runs else []


RESULT = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_token long, n_key long"
)


def scanner():
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text"):
            counts: dict[str, list[int]] = {kind: [] for kind in KINDS}
            digests, spans = [], []
            for _, base, more in found_in(batch.column("text")):
                kinds = [s[2] for s in base + more]
                for kind in KINDS:
                    counts[kind].append(kinds.count(kind))
                digests.append(hashlib.sha256(joined(ordered(base)).encode()).hexdigest())
                spans.append(joined(ordered(base + more)))
            numbers = {k: pa.array(v, pa.int64()) for k, v in counts.items()}
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), numbers["assign"], numbers["access"], numbers["hex"],
                 pa.array(digests, pa.string()), pa.array(spans, pa.string()), numbers["token"], numbers["key"]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_token", "n_key"],
            )
        give_back()

    return run


def scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Counts and spans of secrets, one row per document row; no shuffle. A null text is empty, a null key stays null."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(scanner(), RESULT)


def redact(docs: DataFrame, text: str) -> DataFrame:
    """The rows with every found span of `text` replaced by a mark; other columns and other rows stay as they are."""

    def run(batches):
        import pyarrow as pa

        forget()
        for batch in in_slices(batches, text):
            at = batch.schema.get_field_index(text)
            old = batch.column(at)
            new, changed = [], False
            for i, (whole, base, more) in enumerate(found_in(old)):
                if base or more:
                    changed = True
                    new.append(redacted(whole, base + more))
                else:
                    new.append(old[i].as_py())
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, old.type)) if changed else batch
        give_back()

    return docs.mapInArrow(run, docs.schema)


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
