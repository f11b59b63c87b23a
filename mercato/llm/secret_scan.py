"""Operator 2: secret scans with structural confirmation.

Patterns find candidates; what looks like encoded data is decoded and parsed
before it is reported:

* ``pem``: a private key block whose body decodes and parses, from the nearest
  BEGIN line;
* ``key``: base64 (also over several lines) or hex that decodes to a private key:
  DER (PKCS 1, PKCS 8, encrypted PKCS 8, SEC 1) or the OpenSSH container, every
  nested length filling its container exactly; or base64 of a text that holds a
  ``pem`` (the body of a ``pem`` is a ``key`` as well);
* ``jwt``: a signed token: the header decodes to JSON that names an algorithm,
  the claims decode to JSON, and the signature has the length of the algorithm.

The three base kinds (``assign``, ``access``, ``hex``) are reported by pattern
and length alone and stay, whatever the confirmation says.

Every row is scanned by itself in the task that reads it; nothing is shuffled.

Defined results: null and empty texts have no spans; texts of any length are
scanned whole; repeated rows and repeated or null ids give one row each; other
columns are ignored; an empty table gives none. Offsets are code points, ends
exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import arrow_rows, gives_back, id_and_text

#: Fixed by the query's contract, in the order of the kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN_LEAST = 8
# a run that is too short holds no other match of its kind, so the length is in the pattern
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "key", "jwt")

PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----((?:(?!-----BEGIN ).)*?)-----END \1-----", re.DOTALL)
#: DER of a sequence starts with 0x30, the OpenSSH container with its name, a PEM
#: file with BEGIN; the first line of wrapped base64 has 16 letters at least.
SSH_START, PEM_START = "b3BlbnNzaC1rZXktdjEA", "LS0tLS1CRUdJTi"
KEY_TEXT = re.compile(rf"(?<![A-Za-z0-9+/_-])((?:M[A-Za-z0-9+/_-]{{15}}|{SSH_START}|{PEM_START})[A-Za-z0-9+/_-]*)(={{0,2}})")
KEY_LEAST = 40
#: The next line of wrapped base64; line feeds may be written as in JSON.
NEXT_LINE = re.compile(r"[ \t]*(?:\r?\n|\\r\\n|\\n)[ \t]*([A-Za-z0-9+/_-]+)(={0,2})")
#: What stands between the lines of a wrapped run.
NOT_BASE64 = re.compile(r"\\r\\n|\\n|[ \t\r\n]+")
KEY_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:30|6f70656e7373682d6b65792d7631)(?:[0-9A-Fa-f]{2}){30,}(?![0-9A-Fa-f])")
JWT = re.compile(r"(?<![A-Za-z0-9_-])(e[A-Za-z0-9_-]{9,})\.([A-Za-z0-9_-]{4,})\.([A-Za-z0-9_-]{16,})")

#: Fixed: bytes of a signature by algorithm.
SIGNATURE_BYTES = {"HS256": {32}, "HS384": {48}, "HS512": {64}, "ES256": {64}, "ES384": {96}, "ES512": {132}, "ES256K": {64}, "EDDSA": {64, 114}}
SSH_NAME = b"openssh-key-v1\0"
INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30
#: Fixed: algorithms of PKCS 8 keys (DER of their identifiers).
RSA_KEYS = {bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a864886f70d01010a")}
EC_KEY = bytes.fromhex("2a8648ce3d0201")
#: DSA and Diffie-Hellman: the key is a number.
NUMBER_KEYS = {bytes.fromhex("2a8648ce380401"), bytes.fromhex("2a864886f70d010301"), bytes.fromhex("2a8648ce3e0201")}
#: X25519, X448, Ed25519, Ed448: the key is so many octets.
OCTET_KEYS = {bytes.fromhex("2b656e"): 32, bytes.fromhex("2b656f"): 56, bytes.fromhex("2b6570"): 32, bytes.fromhex("2b6571"): 57}
#: Password-based encryption (PKCS 5 and 12).
ENCRYPTED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


# -- parsers ---------------------------------------------------------------
def der_items(blob: bytes, lo: int, hi: int) -> list[tuple[int, int, int]] | None:
    """(tag, from, to) of the values in a DER region that they fill exactly."""
    out = []
    while lo < hi:
        if hi - lo < 2:
            return None
        tag, n = blob[lo], blob[lo + 1]
        lo += 2
        if n & 0x80:
            width = n & 0x7F
            if not 1 <= width <= 4 or lo + width > hi:
                return None
            n = int.from_bytes(blob[lo : lo + width], "big")
            lo += width
            if n < 0x80:
                return None
        if lo + n > hi:
            return None
        out.append((tag, lo, lo + n))
        lo += n
    return out


def _is_oid(value: bytes) -> bool:
    """Whole base-128 numbers, three bytes at least, none with leading zeros."""
    return len(value) >= 3 and value[-1] < 0x80 and value[0] != 0x80 and not any(a < 0x80 and b == 0x80 for a, b in zip(value, value[1:]))


def _numbers(blob: bytes, items: list[tuple[int, int, int]]) -> list[bytes] | None:
    """The values of items that are all integers (not empty)."""
    if any(t != INTEGER or a == b for t, a, b in items):
        return None
    return [blob[a:b] for _, a, b in items]


def _is_rsa(blob: bytes, items: list[tuple[int, int, int]]) -> bool:
    """PKCS 1: version, modulus, exponents, primes and the rest of them."""
    n = _numbers(blob, items[:9]) if len(items) >= 9 else None
    if n is None or len(n[1]) < 32 or abs(len(n[3]) - len(n[1])) > len(n[1]) // 2:
        return False
    return (n[0] == b"\0" and len(items) == 9) or (n[0] == b"\x01" and len(items) == 10 and items[9][0] == SEQUENCE)


def _is_ec(blob: bytes, items: list[tuple[int, int, int]]) -> bool:
    """SEC 1: version 1, the secret, perhaps the curve and the public point."""
    tags = [t for t, _, _ in items]
    if tags[:2] != [INTEGER, OCTETS] or tags[2:] not in ([], [0xA0], [0xA1], [0xA0, 0xA1]):
        return False
    return blob[items[0][1] : items[0][2]] == b"\x01" and 16 <= items[1][2] - items[1][1] <= 66


def _is_dsa(blob: bytes, items: list[tuple[int, int, int]]) -> bool:
    n = _numbers(blob, items)
    return n is not None and len(n) == 6 and n[0] == b"\0" and len(n[1]) >= 32


def _holds_key(oid: bytes, blob: bytes, lo: int, hi: int) -> bool:
    """Whether the octets of a PKCS 8 key are a key of the algorithm."""
    outer = der_items(blob, lo, hi)
    if outer is None or len(outer) != 1:
        return False
    tag, a, b = outer[0]
    if oid in OCTET_KEYS:
        return tag == OCTETS and b - a == OCTET_KEYS[oid]
    if oid in NUMBER_KEYS:
        return tag == INTEGER and b - a >= 16
    items = der_items(blob, a, b) if tag == SEQUENCE else None
    if oid in RSA_KEYS:
        return items is not None and _is_rsa(blob, items)
    if oid == EC_KEY:
        return items is not None and _is_ec(blob, items)
    return b - a >= 16  # an algorithm that is not known: one value that fills the octets


def is_der_key(blob: bytes) -> bool:
    """A private key in DER: PKCS 8 (plain or encrypted), PKCS 1, SEC 1 or DSA, with
    every version, identifier and nested value as it is defined."""
    outer = der_items(blob, 0, len(blob))
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    items = der_items(blob, *outer[0][1:])
    if not items:
        return False
    tags = [t for t, _, _ in items]

    def algorithm(region: tuple[int, int, int]) -> bytes | None:
        inner = der_items(blob, *region[1:])
        oid = blob[inner[0][1] : inner[0][2]] if inner and inner[0][0] == OID and len(inner) <= 2 else b""
        return oid if _is_oid(oid) else None

    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:  # PKCS 8, perhaps with attributes and a public key
        oid, version = algorithm(items[1]), blob[items[0][1] : items[0][2]]
        if oid is None or version not in (b"\0", b"\x01") or tags[3:] not in ([], [0xA0], [0x81], [0xA1], [0xA0, 0x81], [0xA0, 0xA1]):
            return False
        return _holds_key(oid, blob, *items[2][1:])
    if tags == [SEQUENCE, OCTETS]:  # encrypted PKCS 8
        oid = algorithm(items[0])
        return oid is not None and oid.startswith(ENCRYPTED) and items[1][2] - items[1][1] >= 16
    return _is_rsa(blob, items) or _is_ec(blob, items) or _is_dsa(blob, items)


def der_size(blob: bytes) -> int | None:
    """Bytes of the sequence that a DER text starts with, by its head alone."""
    if len(blob) < 6 or blob[0] != SEQUENCE:
        return None
    width = blob[1] & 0x7F if blob[1] & 0x80 else 0
    if width > 4 or blob[1] == 0x80:
        return None
    return 2 + width + (int.from_bytes(blob[2 : 2 + width], "big") if width else blob[1])


def ssh_size(blob: bytes) -> int | None:
    """Bytes of the OpenSSH container that a text starts with."""
    if not blob.startswith(SSH_NAME):
        return None
    at = len(SSH_NAME)

    def text() -> bytes | None:
        nonlocal at
        if at + 4 > len(blob):
            return None
        n = int.from_bytes(blob[at : at + 4], "big")
        if at + 4 + n > len(blob):
            return None
        at += 4 + n
        return blob[at - n : at]

    head = [text() for _ in range(3)]
    if None in head or not head[0] or at + 4 > len(blob):
        return None
    keys = int.from_bytes(blob[at : at + 4], "big")
    at += 4
    if not 1 <= keys <= 64 or any(not text() for _ in range(keys)):
        return None
    return at if text() else None


def is_ssh_key(blob: bytes) -> bool:
    return ssh_size(blob) == len(blob)


def is_key(blob: bytes | None) -> bool:
    return bool(blob) and (is_der_key(blob) or is_ssh_key(blob))


def from_base64(text: str) -> bytes | None:
    text = text.rstrip("=")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text.replace("-", "+").replace("_", "/") + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_pem_key(body: str) -> bool:
    head, blank, rest = body.replace("\r", "").replace("\\n", "\n").strip().partition("\n\n")
    encrypted = blank and "ENCRYPTED" in head
    blob = from_base64("".join((rest if blank and ":" in head else body.replace("\r", "").replace("\\n", "\n")).split()))
    if encrypted:
        return blob is not None and len(blob) >= 32 and len(blob) % 8 == 0
    return is_key(blob)


def pem_size(blob: bytes) -> int | None:
    """Bytes of a text up to the end of its last private key block."""
    return max((m.end() for m in PEM.finditer(blob.decode("latin-1")) if is_pem_key(m[2])), default=None)


class Wrapped:
    """The lines of base64 that follow places of a text. Each line is matched once;
    lines that go on from one another are numbered and their letters summed up, so
    that the line on which a given number of letters ends is looked up."""

    def __init__(self, text: str):
        self.text = text
        self.chain: dict[int, tuple[int, int]] = {}  # where a line ends: its chain and number
        self.ends: list[list[int]] = []  # of each chain: ends of lines
        self.sums: list[list[int]] = []  # letters up to and with each line

    def _follow(self, at: int) -> tuple[int, int]:
        """Chain and number of the line that ends at ``at``."""
        if at not in self.chain:
            chain, ends, sums = len(self.ends), [at], [0]
            self.ends.append(ends)
            self.sums.append(sums)
            self.chain[at] = chain, 0
            while (m := NEXT_LINE.match(self.text, at)) and not m[1].startswith((SSH_START, PEM_START)):
                at = m.end()
                if at in self.chain:
                    break  # goes on in a chain that is known: it is looked up there
                ends.append(at)
                sums.append(sums[-1] + len(m[1]))
                self.chain[at] = chain, len(ends) - 1
                if m[2]:
                    break
        return self.chain[at] if at in self.chain else (0, 0)

    def line_end(self, at: int, letters: int) -> int | None:
        """Where the line ends with which exactly ``letters`` have followed ``at``."""
        self._follow(at)
        chain, i = self.chain[at]
        sums = self.sums[chain]
        k = bisect_left(sums, sums[i] + letters, i)
        return self.ends[chain][k] if k < len(sums) and sums[k] == sums[i] + letters else None


def key_end(text: str, m: re.Match[str], wrapped: Wrapped) -> int | None:
    """Where the key ends that starts as ``m``, on this line or on one of the next
    lines of base64; the key tells its own length."""
    run = m[1]
    if run[0] == "M":
        if len(run) + len(m[2]) >= KEY_LEAST and is_key(from_base64(m[0])):
            return m.end()
        size = der_size(from_base64(run[:8]) or b"")
        most = None if size is None else (8 * size + 5) // 6
        if m[2] or most is None or most <= len(run) or most < KEY_LEAST:
            return None
        end = wrapped.line_end(m.end(), most - len(run))
        return end if end and is_key(from_base64("".join(NOT_BASE64.sub("", text[m.start() : end])))) else None
    parts, ends, length, last = [run], [(len(run), m.end())], len(run), m
    while not last[last.lastindex]:
        last = NEXT_LINE.match(text, last.end())
        if last is None or last[1].startswith((SSH_START, PEM_START)):
            break
        parts.append(last[1])
        length += len(last[1])
        ends.append((length, last.end()))
    joined = "".join(parts)
    blob = from_base64(joined[: length - (length % 4 == 1)]) or b""
    pem = run.startswith(PEM_START)
    size = pem_size(blob) if pem else ssh_size(blob)
    if size is None:
        return None
    # a line feed may follow the last line of a PEM file
    most = (8 * size + 5) // 6
    return next((end for n, end in ends if n == most or (pem and n > most)), None)


def is_signed_token(header: str, claims: str, signature: str) -> bool:
    parts = [from_base64(x) for x in (header, claims, signature)]
    if None in parts:
        return False
    try:
        head, body = json.loads(parts[0]), json.loads(parts[1])
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    alg = head["alg"].upper()
    if alg in SIGNATURE_BYTES:
        return len(parts[2]) in SIGNATURE_BYTES[alg]
    return alg[:2] in ("RS", "PS") and len(parts[2]) >= 128


# -- scan ------------------------------------------------------------------
def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds."""
    out = []
    low = text.lower()  # a cheap look before the costly pattern; holds every ASCII match
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what decodes and parses."""
    out = []
    if "PRIVATE KEY-----" in text:
        out += [(m.start(), 3, m.end()) for m in PEM.finditer(text) if is_pem_key(m[2])]
    at, wrapped = 0, Wrapped(text)
    for m in KEY_TEXT.finditer(text):
        if m.start() >= at and (end := key_end(text, m, wrapped)):
            out.append((m.start(), 4, end))
            at = end
    for m in KEY_HEX.finditer(text):
        if is_key(bytes.fromhex(m[0])):
            out.append((m.start(), 4, m.end()))
    out += [(m.start(), 5, m.end()) for m in JWT.finditer(text) if is_signed_token(*m.groups())]
    return sorted(out)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in spans])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds (n_assign, n_access,
    n_hex) and of the confirmed ones (n_pem, n_key, n_jwt), base_sha256 and
    ``spans`` as kind:start:end joined by commas, by start, then kind."""

    def make():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, joined = [], []
            for value in b.column(1):
                text = value.as_py()
                base, more = base_spans(text), confirmed_spans(text)
                kinds = [k for _, k, _ in base + more]
                for k, c in enumerate(counts):
                    c.append(kinds.count(k))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(sorted(base + more)))
            return pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(joined, pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

        return fn

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return arrow_rows(id_and_text(docs, id_col, text_col), make, schema)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per span: (doc_id, kind, start, end)."""
    rows = scan_secrets(docs, id_col, text_col).where("spans <> ''")
    parts = rows.select("doc_id", F.explode(F.split("spans", ",")).alias("s")).select("doc_id", F.split("s", ":").alias("s"))
    return parts.select("doc_id", F.col("s")[0].alias("kind"), F.col("s")[1].cast("long").alias("start"), F.col("s")[2].cast("long").alias("end"))


def redact(text: str, mark: str = "[secret]") -> str:
    """The text with every span (overlapping ones as one) replaced."""
    out, at = [], 0
    for a, _, b in sorted(base_spans(text) + confirmed_spans(text)):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text


def redact_secrets(docs: DataFrame, text_col: str = "text", n_chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with all its columns, secrets in the text replaced by a mark and
    the length column (if there is one) brought in line. Null texts stay null."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])
    at = docs.columns.index(text_col)
    has = n_chars_col in docs.columns

    @gives_back
    def run(batches):
        for b in batches:
            old = b.column(at).to_pylist()
            new = [t if t is None else redact(t) for t in old]
            if new != old:
                b = b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))
                if has:
                    i = b.schema.get_field_index(n_chars_col)
                    n = [c if t is u or t == u else len(u) for c, t, u in zip(b.column(i).to_pylist(), old, new)]
                    b = b.set_column(i, b.schema.field(i), pa.array(n, b.schema.field(i).type))
            yield b

    return docs.mapInArrow(run, schema)
