"""Secret scans with structural confirmation.

Patterns find assignments, access keys and long hex runs. Candidates in base64 (standard or URL-safe,
on one line or wrapped, with real or escaped line feeds) and in hex of either case are then decoded
and parsed before they are reported as keys: nested ASN.1 lengths must add up exactly and the
members must be those of a key encoding, OpenSSH fields must fill their container, and a signed
token's header must be JSON that names an algorithm. A key starts where its encoding's first bytes do
and takes whole lines; what its lengths ask for must be there and nothing more on its last line.

Defined results: null and empty texts have no secrets; matches of a kind are leftmost and do not
overlap, those of different kinds may; very long texts are scanned in whole, in time that grows with
their length; repeated rows, and rows with a null ``doc_id``, are scanned like any other; an empty table
gives an empty result; other columns are neither read nor returned.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from cliquespark.llm.shared import texts

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_LEAST = 8
#: Both runs are maximal, so a least length in the pattern finds the same as dropping short matches.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
HEX_KEY = re.compile(r"[0-9A-Fa-f]{32,}")
#: ``{`` and a quote or white space, in base64.
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
ARMOUR = re.compile(r"-----(BEGIN|END) ([A-Z ]*PRIVATE KEY)-----")
ARMOURED = re.compile(r"[A-Za-z0-9+/=\s:,\\-]*")
#: The first line of a bare key: an ASN.1 sequence or the OpenSSH mark in base64, after anything else or an escaped line feed.
KEY64 = re.compile(r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\n))(?:M[A-P]|b3Bl)[A-Za-z0-9+/_-]{14,}")
NEXT_LINE = re.compile(r"(?:\r?\n|\\r\\n|\\n)[ \t]*([A-Za-z0-9+/_-]+)")
#: Larger encodings are no keys.
LARGEST_KEY = 65_536
BASE = ("assign", "access", "hex")
#: The method's own kinds come after the base ones: signed token, armoured key, bare key in base64, bare key in hex.
KINDS = (*BASE, "jwt", "pem", "key64", "keyhex")

SPANS = "doc_id long, n_assign long, n_access long, n_hex long, base string, spans string"


def elements(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """``(tag, start, end)`` of the ASN.1 elements that fill ``data[start:end]`` exactly, or None."""
    found = []
    while start < end:
        if start + 2 > end:
            return None
        tag, size, body = data[start], data[start + 1], start + 2
        if size >= 0x80:
            k = size & 0x7F
            if not 1 <= k <= 4 or body + k > end:
                return None
            size, body = int.from_bytes(data[body : body + k], "big"), body + k
            if size < 0x80 or data[body - k] == 0:  # not the shortest form
                return None
        if body + size > end:
            return None
        found.append((tag, body, body + size))
        start = body + size
    return found


INTEGER, BITS, OCTETS, OBJECT, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30


def is_asn1_key(data: bytes) -> bool:
    """PKCS#1, SEC 1 or PKCS#8, plain or encrypted, judged by members and nested lengths."""
    top = elements(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != SEQUENCE:
        return False
    inside = elements(data, *top[0][1:])
    if not inside or len(inside) < 2:
        return False
    tags = [t for t, _, _ in inside]
    named = lambda x: x[0] == SEQUENCE and bool(e := elements(data, *x[1:])) and e[0][0] == OBJECT
    if tags[0] == INTEGER:
        version = data[inside[0][1] : inside[0][2]]
        if len(tags) >= 9 and all(t == INTEGER for t in tags[:9]) and version in (b"\0", b"\1"):
            return True
        if version == b"\1" and tags[1] == OCTETS and all(t in (0xA0, 0xA1) for t in tags[2:]):
            return inside[1][2] - inside[1][1] >= 16
        if version in (b"\0", b"\1") and len(tags) >= 3 and tags[2] == OCTETS and named(inside[1]):
            return inside[2][2] - inside[2][1] >= 16
    return len(tags) == 2 and named(inside[0]) and tags[1] == OCTETS and inside[1][2] - inside[1][1] >= 32


OPENSSH = b"openssh-key-v1\0"


def openssh_end(data: bytes) -> int | None:
    """Where the OpenSSH key at the start of ``data`` ends."""
    if not data.startswith(OPENSSH):
        return None
    at = len(OPENSSH)

    def take() -> bool:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return False
        at += 4 + size
        return True

    if not all(take() for _ in range(3)) or at + 4 > len(data):
        return None
    count = int.from_bytes(data[at : at + 4], "big")
    at += 4
    return at if 1 <= count <= 16 and all(take() for _ in range(count + 1)) else None


def asn1_end(data: bytes) -> int | None:
    """Where the ASN.1 sequence at the start of ``data`` says that it ends, from its first bytes alone."""
    if len(data) < 6 or data[0] != SEQUENCE:
        return None
    size, body = data[1], 2
    if size >= 0x80:
        k = size & 0x7F
        if not 1 <= k <= 3:
            return None
        size, body = int.from_bytes(data[2 : 2 + k], "big"), 2 + k
    return body + size if data[body] in (INTEGER, SEQUENCE) else None


def is_key(data: bytes) -> bool:
    return is_asn1_key(data) or openssh_end(data) == len(data)


def decode64(text: str) -> bytes | None:
    bare = re.sub(r"\s+", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(bare + "=" * (-len(bare) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(text: str) -> bool:
    head, body, _ = text.split(".")
    try:
        header = json.loads(decode64(head) or b"")
        json.loads(decode64(body) or b"")
    except (ValueError, UnicodeDecodeError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the plain patterns; a match that fails its length is consumed and dropped."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def key64_end(text: str, first: re.Match) -> int | None:
    """Where the bare key that may start with this line ends."""
    line, at = first[0], first.end()
    head = decode64(line[:16]) or b""
    end = asn1_end(head)
    if end is None and not head.startswith(OPENSSH[: len(head)]):
        return None
    wanted = LARGEST_KEY if end is None else -(-end * 4 // 3)
    if wanted > LARGEST_KEY:
        return None
    lines, have, ends = [line], len(line), {len(line): at}
    while have < wanted and (more := NEXT_LINE.match(text, at)):
        lines.append(more[1])
        have, at = have + len(more[1]), more.end()
        ends[have] = at
    if end is None:
        # one letter over a multiple of four is no base64; the key may end before it
        end = openssh_end(decode64("".join(lines)[: have - (have % 4 == 1)]) or b"")
        if end is None:
            return None
        wanted = -(-end * 4 // 3)
    if wanted not in ends or not is_key(decode64("".join(lines)[:wanted]) or b""):
        return None
    at = ends[wanted]
    return at + len(re.match("={0,2}", text[at : at + 2])[0])


def armoured_spans(text: str) -> list[tuple[int, int]]:
    """Keys between a mark and the next one, if that ends the same kind."""
    found, begin = [], None
    for m in ARMOUR.finditer(text):
        if m[1] == "BEGIN":
            begin = m
        elif begin is not None and begin[2] == m[2] and (inner := ARMOURED.fullmatch(text, begin.end(), m.start())):
            plain = inner[0].replace("\\r", "").replace("\\n", "\n")
            data = decode64(re.sub(r"(?m)^[A-Za-z-]+: .*$", "", plain))  # without the headers of encrypted keys
            if data and (is_key(data) or "Proc-Type" in plain and len(data) >= 32 and len(data) % 8 == 0):
                found.append((begin.start(), m.end()))
            begin = None
    return found


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """Candidates that decode and parse."""
    found = [(m.start(), 3, m.end()) for m in TOKEN.finditer(text) if is_signed_token(m[0])]
    armoured = armoured_spans(text) if "-----BEGIN" in text else []
    found += [(start, 4, end) for start, end in armoured]
    starts, last = [start for start, _ in armoured], 0
    for m in KEY64.finditer(text):
        k = bisect.bisect_right(starts, m.start()) - 1
        if m.start() >= last and (k < 0 or armoured[k][1] <= m.start()) and (end := key64_end(text, m)):
            found.append((m.start(), 5, end))
            last = end
    for m in HEX_KEY.finditer(text):
        if (m.end() - m.start()) % 2 == 0 and is_key(bytes.fromhex(m[0])):
            found.append((m.start(), 6, m.end()))
    return found


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts per base kind, base spans, all spans (code points, end exclusive, by start and then kind)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for text in (t.as_py() for t in batch["text"]):
                base = base_spans(text or "")
                kinds = [k for _, k, _ in base]
                values = (*(kinds.count(k) for k in range(3)), spell(base), spell(sorted(base + confirmed_spans(text or ""))))
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, t) for c, t in zip(out, kinds, strict=True))], names=["doc_id", "n_assign", "n_access", "n_hex", "base", "spans"])

    return texts(docs, id_col, text_col).mapInArrow(run, SPANS)


def redact(text: str, mark: str = "[secret]") -> str:
    """The text with every span, overlapping ones joined, replaced by a mark."""
    out, at = [], 0
    for start, _, end in sorted(base_spans(text) + confirmed_spans(text)):
        if end > at:
            if start >= at:
                out += [text[at:start], mark]
            at = end
    return "".join([*out, text[at:]])

