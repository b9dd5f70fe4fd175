"""Operator 11: secrets in texts, with structural confirmation of encoded ones.

Base spans come from patterns: assignments of a value of 12 or more characters to a name like password or token, access
key ids, and runs of 16 or more hex figures, each kind leftmost and non-overlapping. Encoded candidates are reported only
if their content proves what they are:

- jwt: three base64url parts whose first is a JSON object with a text "alg"; the signature may be empty for "none" alone
- key: base64 or hex that decodes to a private key: DER whose nested lengths fill each other exactly (RSA, DSA, EC,
  PKCS#8 and its encrypted form), or the OpenSSH form with its length-prefixed fields. A value broken over lines is
  followed as far as its outer length says
- pem: an armour of a PRIVATE KEY whose body proves itself as above, or is encrypted whole blocks with the headers that say so
- wrapped: base64 or hex that decodes to printable text that holds a secret itself (base spans of hex alone don't count);
  each layer is shorter than the one around it, so that the search ends

A text is searched whole, by a task of its own rows; nothing is shuffled. Spans are code points, end exclusive. Overlapping
spans of different kinds all stay. A null text is empty; rows without doc_id, rows that repeat, and ties are kept, each by
itself; other columns are ignored by find_secrets() and kept by redact(). Memory follows the longest text.
"""

import base64
import binascii
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .spans import LOWER, text_blocks

KINDS = ("assign", "access", "hex", "jwt", "pem", "key", "wrapped")
BASE = KINDS[:3]
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX, LEAST_TOKEN, LEAST_CODED = 12, 18, 16, 20, 24

_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: On bytes with A-Z lower-cased, which stands for letters in either case.
_ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_BEGIN = re.compile(rb"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?)-----")


def _among(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_LOW_HEX, _HEX = _among("0123456789abcdef"), _among("0123456789abcdefABCDEF")
_TOKEN, _CODED = _among(_ALNUM + "_-."), _among(_ALNUM + "+/_-")
_PRINTABLE = bytes([9, 10, 13, *range(32, 127)])
_STANDARD = bytes.maketrans(b"-_", b"+/")


def _runs(inside: np.ndarray, offsets: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs of at least so many bytes; none crosses a text's border."""
    if len(inside) < least:
        return []
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    cuts = np.concatenate([[0], edge, [len(inside)]])
    size = np.diff(cuts)
    long = np.flatnonzero((size >= least) & inside[cuts[:-1]])
    out = []
    for s, e in zip(cuts[long].tolist(), cuts[long + 1].tolist(), strict=True):
        at = [s, *offsets[np.searchsorted(offsets, s, "right") : np.searchsorted(offsets, e)].tolist(), e]
        out += [(a, b) for a, b in zip(at, at[1:], strict=False) if b - a >= least]
    return out


def _decoded(coded: bytes) -> bytes | None:
    """Of base64 in either alphabet, with or without padding."""
    coded = coded.rstrip(b"=").translate(_STANDARD)
    if len(coded) % 4 == 1:
        return None
    try:
        return base64.b64decode(coded + b"=" * (-len(coded) % 4), validate=True)
    except binascii.Error:
        return None


# --- what proves a decoded value ---


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, and where the content of the DER element at this place begins and ends; its length has the shortest form."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            return None
        size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if size < 0x80 or size < 1 << 8 * (n - 1):
            return None
    return (tag, at, at + size) if at + size <= end else None


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """All elements between two places, which they fill exactly."""
    out = []
    while at < end:
        got = _tlv(data, at, end)
        if got is None:
            return None
        out.append(got)
        at = got[2]
    return out


def der_private_key(data: bytes) -> bool:
    """Is data one private key, every length nested in the one around it?"""
    top = _tlv(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    parts = _elements(data, top[1], top[2])
    if not parts:
        return False
    tags = [p[0] for p in parts]
    version = int.from_bytes(data[parts[0][1] : parts[0][2]], "big") if tags[0] == 2 and parts[0][2] - parts[0][1] == 1 else None
    if version in (0, 1) and set(tags) == {2} and len(tags) in (6, 9, 10):  # DSA; RSA
        return all(e > s and not data[s] & 0x80 for _, s, e in parts)
    if version == 0 and len(tags) == 10 and tags[:9] == [2] * 9 and tags[9] == 0x30:
        return True
    if version == 1 and tags[:2] == [2, 4] and set(tags[2:]) <= {0xA0, 0xA1}:  # EC
        return parts[1][2] - parts[1][1] >= 16 and all(_elements(data, s, e) is not None for _, s, e in parts[2:])
    if version in (0, 1) and tags[:3] == [2, 0x30, 4] and set(tags[3:]) <= {0xA0, 0x81, 0xA1}:  # PKCS#8
        return _algorithm(data, parts[1]) and bool(_elements(data, parts[2][1], parts[2][2]))
    if tags == [0x30, 4]:  # PKCS#8, encrypted
        inner = _elements(data, parts[0][1], parts[0][2])
        return _algorithm(data, parts[0]) and len(inner) == 2 and inner[1][0] == 0x30 and parts[1][2] - parts[1][1] >= 16
    return False


def _algorithm(data: bytes, part: tuple[int, int, int]) -> bool:
    inner = _elements(data, part[1], part[2])
    return bool(inner) and inner[0][0] == 6 and inner[0][2] > inner[0][1]


_MAGIC = b"openssh-key-v1\0"


def openssh_size(data: bytes) -> int | None:
    """Bytes of the OpenSSH key that begins so, as far as its lengths say: magic, three fields, the number of keys (one, in this
    version), the public key and the private part, each with its length before it. Over len(data): at least so many."""
    if not data.startswith(_MAGIC[: len(data)]):
        return None
    at = len(_MAGIC)
    for field in ("cipher", "derivation", "options", None, "public", "private"):
        if at + 4 > len(data):
            return at + 4
        value, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        if field:
            at += value
        elif value != 1:
            return None
    return at


def openssh_private_key(data: bytes) -> bool:
    return openssh_size(data) == len(data)


def private_key(data: bytes) -> bool:
    return der_private_key(data) or openssh_private_key(data)


def signed_token(head: bytes, body: bytes, signature: bytes) -> bool:
    if not head or not body or any(b"+" in x or b"/" in x for x in (head, body, signature)):
        return False
    decoded = _decoded(head)
    if not decoded or decoded.lstrip()[:1] != b"{":
        return False
    try:
        fields = json.loads(decoded)
    except (ValueError, RecursionError):
        return False
    if not isinstance(fields, dict) or not isinstance(fields.get("alg"), str) or not fields["alg"]:
        return False
    return _decoded(body) is not None and (bool(_decoded(signature)) if signature else fields["alg"].lower() == "none")


# --- candidates ---


def _tokens(data: bytes, buf: np.ndarray, offsets: np.ndarray):
    for s, e in _runs(_TOKEN[buf], offsets, LEAST_TOKEN):
        parts = data[s:e].split(b".")
        if len(parts) < 3:
            continue
        starts, i = np.append(0, np.cumsum([len(p) + 1 for p in parts])).tolist(), 0
        while i + 2 < len(parts):
            if signed_token(*parts[i : i + 3]):
                yield "jwt", s + starts[i], s + starts[i + 2] + len(parts[i + 2])
                i += 3
            else:
                i += 1


def _armours(data: bytes, offsets: np.ndarray):
    found = [(m.start(), m.end(), m[1]) for m in _BEGIN.finditer(data)] if b"-----BEGIN " in data else []
    for k, (start, body, label) in enumerate(found):
        border = int(offsets[np.searchsorted(offsets, start, "right")])
        if body > border:
            continue
        end_line = b"-----END " + label + b"-----"
        end = data.find(end_line, body, min(border, found[k + 1][0] if k + 1 < len(found) else border))
        if end >= 0 and _armoured(data[body:end], label):
            yield "pem", start, end + len(end_line)


def _armoured(body: bytes, label: bytes) -> bool:
    lines = [x.strip() for x in body.replace(b"\\n", b"\n").splitlines()]
    headers = [x for x in lines if b":" in x]
    checksum = [x for x in lines if x.startswith(b"=") and len(x) == 5]
    decoded = _decoded(b"".join(x for x in lines if x and b":" not in x and x not in checksum))
    if not decoded:
        return False
    if label.endswith(b"BLOCK"):  # packets: a secret key first, its length within the body
        first, size = decoded[0], None
        if first & 0xC0 == 0x80 and (first >> 2) & 15 == 5 and first & 3 < 3:
            size = 1 + (1 << (first & 3)) + int.from_bytes(decoded[1 : 1 + (1 << (first & 3))], "big")
        elif first == 0xC5 and len(decoded) > 2:
            second = decoded[1]
            size = 2 + second if second < 192 else 3 + ((second - 192) << 8) + decoded[2] + 192 if second < 224 else 6 + int.from_bytes(decoded[2:6], "big")
        return size is not None and size <= len(decoded)
    encrypted = any(x.startswith(b"Proc-Type:") and b"ENCRYPTED" in x for x in headers) and any(x.startswith(b"DEK-Info:") for x in headers)
    return private_key(decoded) or encrypted and len(decoded) % 8 == 0


def _follow(data: bytes, start: int, need: int, border: int) -> tuple[bytes, int]:
    """So many base64 characters from start on, over line breaks and blanks between them; and where they end."""
    out, at = [], start
    while need > 0 and at < border:
        stop = at
        while stop < border and _CODED[data[stop]] and stop - at < need:
            stop += 1
        if stop == at:
            break
        out.append(data[at:stop])
        need, at = need - (stop - at), stop
        if need > 0:
            gap = at
            while gap < border and data[gap] in b" \t\r\n" and gap - at < 8:
                gap += 1
            if gap == at:
                break
            at = gap
    while out and data[at - 1] in b" \t\r\n":
        at -= 1
    return b"".join(out), at


def _outer_length(head: bytes) -> int | None:
    """Bytes of the DER sequence that begins so, if its first element can begin a private key."""
    if len(head) < 8 or head[0] != 0x30:
        return None
    n = head[1] & 0x7F if head[1] & 0x80 else 0
    if n > 4:
        return None
    first = head[2 + n : 5 + n]
    if first[:2] != b"\x02\x01" and first[:1] != b"\x30":
        return None
    return 2 + n + (int.from_bytes(head[2 : 2 + n], "big") if n else head[1])


def _coded(data: bytes, buf: np.ndarray, offsets: np.ndarray):
    """Keys and wrapped secrets in base64."""
    done = 0
    for s, e in _runs(_CODED[buf], offsets, LEAST_CODED):
        if s < done:
            continue
        border = int(offsets[np.searchsorted(offsets, s, "right")])
        found = None
        for at in [s, *(s + 1 + m.start() for m in re.finditer(rb"(?=MI|MC4C|b3BlbnNzaC1rZXk)", data[s + 1 : e]))]:
            found = _key_at(data, at, e, border)
            if found:
                yield "key", at, found
                done = max(done, found)
                break
        if not found and _holds_secret(_decoded(data[s:e])):
            end = e
            while end < border and end - e < 2 and data[end] == 61:
                end += 1
            yield "wrapped", s, end


def _key_at(data: bytes, at: int, end: int, border: int) -> int | None:
    """Where a key that begins here in base64 ends."""
    head = _decoded(data[at : at + 16]) if end - at >= 16 else None
    if head is None:
        return None
    size = _outer_length(head)
    if size is not None and size * 4 // 3 <= border - at:
        coded, stop = _follow(data, at, -(-size * 4 // 3), border)
    elif head.startswith(_MAGIC[: len(head)]):
        need, have = openssh_size(head), len(head)
        while need is not None and need > have:
            coded, stop = _follow(data, at, -(-need * 4 // 3), border)
            decoded = _decoded(coded) or b""
            if len(decoded) < need:
                return None
            need, have = openssh_size(decoded), need
        if need is None:
            return None
    else:
        return None
    decoded = _decoded(coded)
    if decoded is None or not private_key(decoded):
        return None
    first = stop
    while stop < border and stop - first < 2 and data[stop] == 61:
        stop += 1
    return stop


def _figures(data: bytes, buf: np.ndarray, offsets: np.ndarray):
    """Keys and wrapped secrets in hex."""
    for s, e in _runs(_HEX[buf], offsets, LEAST_CODED):
        decoded = bytes.fromhex(data[s : e - (e - s) % 2].decode())
        if private_key(decoded):
            yield "key", s, e - (e - s) % 2
        elif _holds_secret(decoded):
            yield "wrapped", s, e - (e - s) % 2


def _holds_secret(data: bytes | None) -> bool:
    if not data or data[:4096].translate(None, _PRINTABLE) or data.translate(None, _PRINTABLE):
        return False
    buf, offsets = np.frombuffer(data, np.uint8), np.array([0, len(data)])
    return any(kind != "hex" for kind, _, _ in _spans(data, buf, offsets))


def _places(data: bytes, offsets: np.ndarray, words: tuple[bytes, ...]) -> list[int]:
    """Numbers of the texts that hold one of the words (or seem to, across a border)."""
    out = set()
    for word in words:
        at = data.find(word)
        while at >= 0:
            text = int(np.searchsorted(offsets, at, "right")) - 1
            out.add(text)
            at = data.find(word, max(at + 1, int(offsets[text + 1]) - len(word) + 1))
    return sorted(out)


def _spans(data: bytes, buf: np.ndarray, offsets: np.ndarray):
    """(kind, start, end) in bytes of the block."""
    low = LOWER[buf].tobytes()
    for i in _places(low, offsets, _WORDS):
        for m in _ASSIGN.finditer(low, int(offsets[i]), int(offsets[i + 1])):
            if m.end(2) - m.start(2) >= LEAST_VALUE:
                yield "assign", m.start(), m.end()
    for i in _places(data, offsets, (b"AKIA",)):
        for m in _ACCESS.finditer(data, int(offsets[i]), int(offsets[i + 1])):
            if m.end() - m.start() >= LEAST_ACCESS:
                yield "access", m.start(), m.end()
    for s, e in _runs(_LOW_HEX[buf], offsets, LEAST_HEX):
        yield "hex", s, e
    yield from _tokens(data, buf, offsets)
    yield from _armours(data, offsets)
    yield from _coded(data, buf, offsets)
    yield from _figures(data, buf, offsets)


def _found(buf: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """(text, start and end in code points, kind's number, start and end in bytes of the text), in order."""
    spans = list(_spans(buf.tobytes(), buf, offsets))
    if not spans:
        return []
    before = np.append(0, np.cumsum((buf & 0xC0) != 0x80))
    kind = np.array([KINDS.index(k) for k, _, _ in spans])
    start, end = np.array([s[1] for s in spans]), np.array([s[2] for s in spans])
    text = np.searchsorted(offsets, start, "right") - 1
    first = offsets[text]
    out = zip(text.tolist(), (before[start] - before[first]).tolist(), (before[end] - before[first]).tolist(), kind.tolist(), (start - first).tolist(), (end - first).tolist(), strict=True)
    return sorted(set(out), key=lambda x: (x[0], x[1], x[3], x[2]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _find(batches):
    for rows, buf, offsets in text_blocks(batches, "doc_id", "text"):
        lists = [[] for _ in range(rows.num_rows)]
        for text, start, end, kind, _, _ in _found(buf, offsets):
            lists[text].append({"kind": KINDS[kind], "start": start, "end": end})
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(lists, _SPANS)], names=["doc_id", "spans"])


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, spans: array of (kind, start, end), by start and then by kind in the order of KINDS."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = StructType([docs.schema["doc_id"]])
    span = StructType().add("kind", "string").add("start", "long").add("end", "long")
    return docs.mapInArrow(_find, schema.add("spans", ArrayType(span)))


def _redacted(batches):
    for batch in batches:
        names = batch.schema.names
        for rows, buf, offsets in text_blocks([batch], "text", "text"):
            cuts: dict[int, list] = {}
            for text, _, _, kind, start, end in _found(buf, offsets):
                cuts.setdefault(text, []).append((start, end, kind))
            texts = rows.column("text").to_pylist()
            for i, spans in cuts.items():
                raw, out, at = texts[i].encode(), [], 0
                for start, end, kind in sorted(spans):
                    if start >= at:
                        out += [raw[at:start], b"[" + KINDS[kind].encode() + b"]"]
                    at = max(at, end)
                texts[i] = b"".join([*out, raw[at:]]).decode()
            new = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([new if n == "text" else rows.column(n) for n in names], names=names)


def redact(docs: DataFrame) -> DataFrame:
    """docs with each secret's text, spans that overlap taken together, replaced by its kind in brackets."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    return docs.mapInArrow(_redacted, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    rows = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    listed = "array_join(transform({}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"
    count = [F.expr(f"cast(size(filter(spans, x -> x.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE]
    base = F.expr(listed.format(f"filter(spans, x -> x.kind in {BASE})"))
    return rows.select("doc_id", *count, F.sha2(base, 256).alias("base_sha256"), F.expr(listed.format("spans")).alias("spans"))
