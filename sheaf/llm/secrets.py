"""Secret scans with structural confirmation (operator 6).

Plain patterns give the base spans: assignments, access keys, long hex. Candidates in base64 or hex are then decoded and must
prove a structure before they are reported:

- jwt: three parts of which the first two are JSON objects, the header names its algorithm, and the signature isn't empty. It
  begins where its run of base64 letters begins.
- pem: armour of a private key, from the last BEGIN before an END of the same label, around a private key in DER, an OpenSSH or
  OpenPGP secret key, or (with DEK-Info) whole cipher blocks.
- der: base64 (one line, or neighbouring lines of one width; either alphabet) or hex of a private key in DER.
- ssh: base64 of an OpenSSH private key container.

Kinds of DER are told apart by their members: PKCS#1, DSA, SEC 1, PKCS#8 and encrypted PKCS#8 private keys count; public keys,
certificates, signatures and other sequences don't. Every scan is linear in the text: runs, lines and armour are each looked at once.

Defined results: a null or empty text has no spans; spans are in code points, end exclusive, by start, then by kind as in
KINDS; spans of different kinds may overlap; repeated rows are scanned each for itself; an empty table gives no rows; further
columns are not looked at.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sheaf.llm.common import prepare, table, to_batch

#: Base kinds first; the method adds the rest.
KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "ssh")
ORDER = {k: i for i, k in enumerate(KINDS)}
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_HEADER = 15  # letters of the shortest header that names an algorithm, {"alg":"x"}
TOKEN_RUN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+)++")
ARMOUR = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]++)-----")
ARMOUR_HEADER = re.compile(r"(?m)^([A-Za-z-]+): (.*)$")
DEK_INFO = re.compile(r"[A-Z0-9-]+,[0-9A-F]{16,}")
#: Base64 up to the end of a line, and what the following lines begin with.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}+={0,2}(?:\r?\n[A-Za-z0-9+/_-]++={0,2})*+")
LINE = re.compile(r"[^\r\n=]+={0,2}")
HEXES = re.compile(r"(?:[0-9a-f]{2}){24,}|(?:[0-9A-F]{2}){24,}")
#: Object identifiers of password-based encryption begin so, in DER (PKCS#5 and PKCS#12).
PASSWORD_BASED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
OPENSSH = b"openssh-key-v1\0"
INTEGER, OCTETS, OID, SEQUENCE, PART_0, PART_1 = 0x02, 0x04, 0x06, 0x30, 0xA0, 0xA1


def decode64(s: str) -> bytes | None:
    s = re.sub(r"\s", "", s).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_end(raw: bytes, at: int = 0) -> tuple[int, int, int] | None:
    """Tag, begin and end of the value at `at`; None if the length is not in DER or goes beyond the bytes."""
    if at + 2 > len(raw):
        return None
    n, begin = raw[at + 1], at + 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or begin + k > len(raw) or raw[begin] == 0:
            return None
        n = int.from_bytes(raw[begin : begin + k], "big")
        if n < 0x80:
            return None
        begin += k
    return (raw[at], begin, begin + n) if begin + n <= len(raw) else None


def members(raw: bytes, begin: int, end: int) -> list[tuple[int, int, int]] | None:
    """Tag, begin and end of each value between begin and end; None if they don't fill that place."""
    out = []
    while begin < end:
        part = der_end(raw, begin)
        if part is None or part[2] > end:
            return None
        out.append(part)
        begin = part[2]
    return out


def der_key_end(raw: bytes | None) -> int | None:
    """Where the private key in DER that the bytes begin with ends; None if they begin with none."""
    if not raw or raw[0] != SEQUENCE or (top := der_end(raw)) is None or not (parts := members(raw, top[1], top[2])):
        return None
    tags = [t for t, _, _ in parts]
    value = lambda k: raw[parts[k][1] : parts[k][2]]

    def algorithm(k: int) -> bytes | None:
        """The object identifier that the sequence at k begins with."""
        inner = members(raw, parts[k][1], parts[k][2]) if tags[k] == SEQUENCE else None
        return raw[inner[0][1] : inner[0][2]] if inner and inner[0][0] == OID else None

    numbers = tags.count(INTEGER) == len(tags)
    versioned = tags[0] == INTEGER and value(0) in (b"\0", b"\1")
    rsa = versioned and tags[:9] == [INTEGER] * 9 and (len(tags) == 9 or tags[9:] == [SEQUENCE])
    dsa = versioned and numbers and len(tags) == 6
    elliptic = versioned and value(0) == b"\1" and tags[1:2] == [OCTETS] and 20 <= len(value(1)) <= 66 and set(tags[2:]) <= {PART_0, PART_1}
    wrapped = versioned and len(tags) >= 3 and tags[2] == OCTETS and algorithm(1) is not None and set(tags[3:]) <= {PART_0, PART_1, 0x81}
    encrypted = tags == [SEQUENCE, OCTETS] and (algorithm(0) or b"").startswith(PASSWORD_BASED)
    return top[2] if rsa or dsa or elliptic or wrapped or encrypted else None


def ssh_key_end(raw: bytes | None) -> int | None:
    """Where the OpenSSH private key container that the bytes begin with ends: cipher, key derivation and its options, a count, so many public keys, the private part."""
    if not raw or not raw.startswith(OPENSSH):
        return None

    def field(at: int) -> int | None:
        end = at + 4 + int.from_bytes(raw[at : at + 4], "big")
        return end if at + 4 <= len(raw) and end <= len(raw) else None

    at: int | None = len(OPENSSH)
    for _ in range(3):
        if (at := field(at)) is None:
            return None
    count = int.from_bytes(raw[at : at + 4], "big")
    if not 1 <= count <= len(raw):
        return None
    at += 4
    for _ in range(count + 1):
        if (at := field(at)) is None:
            return None
    return at


def is_pgp_secret(raw: bytes | None) -> bool:
    """A first OpenPGP packet that is a secret key: tag 5, in the old or the new format."""
    return bool(raw) and len(raw) > 16 and (raw[0] & 0xFC == 0x94 or raw[0] == 0xC5)


def json_object(s: str) -> dict | None:
    try:
        got = json.loads(decode64(s) or b"")
    except (ValueError, RecursionError):
        return None
    return got if isinstance(got, dict) else None


def tokens_of(run: str) -> Iterator[tuple[int, int]]:
    """Begin and end of the signed tokens in a run of base64 letters and dots."""
    parts, at, k = run.split("."), 0, 0
    while k + 2 < len(parts):
        size = len(parts[k])
        if size >= LEAST_HEADER and parts[k].startswith("eyJ") and parts[k + 2] and isinstance((json_object(parts[k]) or {}).get("alg"), str) and json_object(parts[k + 1]) is not None and decode64(parts[k + 2]):
            end = at + size + len(parts[k + 1]) + len(parts[k + 2]) + 2
            yield at, end
            at, k = end + 1, k + 3
        else:
            at, k = at + size + 1, k + 1


def armoured(text: str) -> Iterator[tuple[int, int]]:
    """Begin and end of confirmed private keys in armour. A BEGIN that another one follows before its END is no key's."""
    begun: re.Match | None = None
    for m in ARMOUR.finditer(text):
        if m[1] == "BEGIN":
            begun = m
        elif begun is not None:
            if begun[2] == m[2] and "PRIVATE KEY" in m[2] and is_private_armour(m[2], text[begun.end() : m.start()]):
                yield begun.start(), m.end()
            begun = None


def is_private_armour(label: str, body: str) -> bool:
    headers = dict(ARMOUR_HEADER.findall(body))
    body = ARMOUR_HEADER.sub("", body)
    if "PGP" in label:
        return is_pgp_secret(decode64("\n".join(x for x in body.split("\n") if not x.startswith("="))))
    raw = decode64(body)
    if not raw:
        return False
    if "DEK-Info" in headers:
        return "ENCRYPTED" in headers.get("Proc-Type", "") and DEK_INFO.match(headers["DEK-Info"]) is not None and len(raw) >= 32 and len(raw) % 8 == 0
    return len(raw) in (der_key_end(raw), ssh_key_end(raw))


class Lines:
    """Neighbouring lines of base64: spans, letters before each (padding not counted), and how far a key that begins with each can go.

    A key goes over lines of one width; the last can be shorter. Padding ends a key. Only the block's first line can begin inside a line, after
    other text (`inside`); then the second line gives the width.
    """

    def __init__(self, block: str, inside: bool):
        self.block = block
        self.spans = [m.span() for m in LINE.finditer(block)]
        padded = [block[b - 1] == "=" for _, b in self.spans]
        self.before = [0]
        for (a, b), pad in zip(self.spans, padded, strict=True):
            self.before.append(self.before[-1] + (len(block[a:b].rstrip("=")) if pad else b - a))
        n = len(self.spans)
        width = [b - a for a, b in self.spans]
        self.reach = list(range(n))
        for k in reversed(range(n - 1)):
            if padded[k]:
                continue
            if width[k + 1] == width[k] or (k == 0 and inside):
                self.reach[k] = self.reach[k + 1]
            elif width[k + 1] < width[k]:
                self.reach[k] = k + 1

    def letters(self, first: int, last: int, most: int) -> str:
        """The letters from line `first` to line `last`, `most` of them at most."""
        out, at = [], first
        while at <= last and self.before[at] - self.before[first] < most:
            a, _ = self.spans[at]
            out.append(self.block[a : a + self.before[at + 1] - self.before[at]])
            at += 1
        return "".join(out)[:most]

    def key_at(self, k: int) -> tuple[str, int] | None:
        """Kind and last line of the private key that begins with line k, if it ends where a line does.

        Not more is decoded than the key's own length says (DER), or about twice the key (SSH).
        """
        last = self.reach[k]
        a, b = self.spans[k]
        first = decode64(self.block[a : min(b, a + 20)]) or b""
        if first == OPENSSH:
            kind, want = "ssh", 256
        elif first[:1] == b"0" and len(first) > 6:
            n = first[1] & 0x7F if first[1] & 0x80 else 0
            kind, want = "der", 2 + n + (int.from_bytes(first[2 : 2 + n], "big") if n else first[1])
        else:
            return None
        most = (self.before[last + 1] - self.before[k]) * 3 // 4
        if kind == "der" and want > most:
            return None
        while True:
            part = self.letters(k, last, -(-want * 4 // 3))
            raw = decode64(part[: len(part) - (len(part) % 4 == 1)])
            size = ssh_key_end(raw) if kind == "ssh" else der_key_end(raw)
            if size is not None or kind == "der" or want >= most:
                break
            want *= 2
        if size is None:
            return None
        end = self.before[k] + -(-size * 4 // 3)
        at = bisect.bisect_left(self.before, end, k + 1, last + 2)
        return (kind, at - 1) if at <= last + 1 and self.before[at] == end else None


def keys_in_block(block: str, inside: bool) -> Iterator[tuple[int, int, str]]:
    """Private keys in neighbouring lines of base64: after a key the search goes on behind it.

    Where a line begins no key, the lines that it could have gone over are not looked at again, but for those after a first line
    inside other text. So each line is decoded twice at most, whatever keys there are.
    """
    lines = Lines(block, inside)
    k = 0
    while k < len(lines.spans):
        found = lines.key_at(k)
        if found is None:
            k = 1 if k == 0 and inside else lines.reach[k] + 1
        else:
            yield lines.spans[k][0], lines.spans[found[1]][1], found[0]
            k = found[1] + 1


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return spans + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    spans = []
    if "eyJ" in text:
        for m in TOKEN_RUN.finditer(text):
            if "eyJ" in m[0]:
                spans += [(m.start() + a, m.start() + b, "jwt") for a, b in tokens_of(m[0])]
    if "-----END " in text:
        spans += [(a, b, "pem") for a, b in armoured(text)]
    for m in BASE64.finditer(text):
        spans += [(m.start() + a, m.start() + b, kind) for a, b, kind in keys_in_block(m[0], m.start() > 0 and text[m.start() - 1] != "\n")]
    for m in HEXES.finditer(text):
        if m[0].startswith("30") and der_key_end(raw := bytes.fromhex(m[0])) == len(raw):
            spans.append((m.start(), m.end(), "der"))
    return spans


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], ORDER[s[2]], s[1])))


OUT = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows: dict[str, list] = {c: [] for c in OUT.names}
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            base = base_spans(text or "")
            more = confirmed_spans(text or "")
            kinds = [k for _, _, k in base]
            for c, v in zip(OUT.names, (doc_id, kinds.count("assign"), kinds.count("access"), kinds.count("hex"), hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + more)), strict=True):
                rows[c].append(v)
        yield to_batch(rows, OUT)


def secret_spans(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of each document's spans. A projection: no shuffle, any partition can be run again."""
    prepare(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(text: str, mark: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones joined, replaced by a mark."""
    out, at = [], 0
    merged: list[list[int]] = []
    for a, b, _ in sorted(base_spans(text) + confirmed_spans(text)):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))
