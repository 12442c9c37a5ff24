"""Secret scanning with structural confirmation.

Three patterns give the base findings: assignments, access key ids and hex runs. On
top, base64 and hex runs are decoded and parsed, and are reported when they hold a
private key or a signed token: DER encodings whose nested lengths add up and whose
fields are those of a private key (a short version number first and a long number or
octet string after it, or an algorithm and an enciphered octet string), private key
containers made of length-prefixed fields, and tokens whose header is a JSON object that
names an algorithm. Public keys, certificates and parameters have other shapes and are
not reported. Base64 and PEM bodies are joined over real and escaped line ends before they
are parsed; an encoding in a run is as long as its own header says, so that what stands
before or after it in the run does no harm.

Work is linear in the text: a run is joined once, a candidate decodes only the headers of
its fields, and a key has no more than ``MOST_FIELDS`` of these. Whole texts are scanned,
row by row, in Arrow batches; no row needs another.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "token", "der", "blob", "pem")


def _either_case(pattern: str) -> str:
    return re.sub(r"[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", pattern)


ASSIGN = re.compile(f"({_either_case('password|passwd|secret|token|api_?key')})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
JOINED = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}={0,2}")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{10,}+)\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]*)")
ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{32,}")
BREAK = r"(?:(?:\\{1,2}r)?\\{1,2}n|\r?\n)[\x20\t]*"
#: A base64 run that may go on over line ends; places in a run where an encoding may begin.
WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{24,}}+(?:{BREAK}(?!-----)[A-Za-z0-9+/_-]++)*={{0,2}}")
BEGIN = re.compile(r"(?:(?<![A-Za-z0-9])|(?<=\\n))(?:M|b3Bl)")
CHARS = re.compile(rf"{BREAK}|([A-Za-z0-9+/_-]+)")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[^-]|-(?!----))++)-----END \1-----")
CONTAINER = b"openssh-key-v1\0"
#: More fields than any private key has, nested ones included.
MOST_FIELDS = 256
Reader = Callable[[int, int], bytes]


def decode_base64(run: str) -> bytes | None:
    body = run.rstrip("=").translate(str.maketrans("-_", "+/"))
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def bytes_reader(data: bytes) -> Reader:
    return lambda at, n: data[at : at + n]


def base64_reader(run: str, start: int) -> Reader:
    """Reads some bytes of the encoding that begins at ``start``, decoding no more than these."""
    def read(at: int, n: int) -> bytes:
        lo = start + at // 3 * 4
        chunk = run[lo : start + (at + n + 2) // 3 * 4]
        data = decode_base64(chunk[: len(chunk) - (len(chunk) % 4 == 1)]) or b""
        return data[at % 3 : at % 3 + n]

    return read


def hex_reader(run: str, start: int) -> Reader:
    return lambda at, n: bytes.fromhex(run[start + 2 * at : min(start + 2 * (at + n), len(run) - (len(run) - start) % 2)])


def der_field(read: Reader, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, where its content begins, where it ends) of the field at ``at``, None if it doesn't fit before ``end``."""
    head = read(at, min(6, end - at))
    if len(head) < 2:
        return None
    size, body = head[1], 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or len(head) < 2 + n:
            return None
        size, body = int.from_bytes(head[2 : 2 + n], "big"), 2 + n
    return (head[0], at + body, at + body + size) if at + body + size <= end else None


def der_key_size(read: Reader, most: int) -> int:
    """The size of the private key encoding that begins what ``read`` gives, 0 if there is none within ``most`` bytes."""
    whole = der_field(read, 0, most)
    if whole is None or whole[0] != 0x30 or whole[2] < 16:
        return 0
    todo, top, first_inner, seen = [(whole[1], whole[2], True)], [], 0, 0
    while todo:
        at, end, outer = todo.pop()
        while at < end:
            field = der_field(read, at, end)
            seen += 1
            if field is None or seen > MOST_FIELDS:
                return 0
            tag, lo, hi = field
            if tag not in (0x02, 0x03, 0x04, 0x05, 0x06, 0x0C, 0x13, 0x17, 0x18, 0x30, 0x31, 0xA0, 0xA1) or (tag == 0x02 and lo == hi):
                return 0
            if outer:
                top.append((tag, hi - lo))
                first_inner = read(lo, 1)[:1] if len(top) == 1 and tag == 0x30 else first_inner
            if tag in (0x30, 0x31):
                todo.append((lo, hi, False))
            at = hi
    plain = top[0] in ((0x02, 1), (0x02, 2)) and any(tag in (0x02, 0x04) and size >= 16 for tag, size in top[1:])
    enciphered = [tag for tag, _ in top] == [0x30, 0x04] and first_inner == b"\x06" and top[1][1] >= 16
    return whole[2] if plain or enciphered else 0


def container_size(read: Reader, most: int) -> int:
    """The size of the private key container that begins what ``read`` gives, 0 if its fields don't add up."""
    if read(0, len(CONTAINER)) != CONTAINER:
        return 0
    at = len(CONTAINER)

    def after(at: int) -> int:
        size = read(at, 4)
        return at + 4 + int.from_bytes(size, "big") if len(size) == 4 else most + 1

    for _ in range(3):  # cipher, derivation and its options
        at = after(at)
        if at > most:
            return 0
    keys = int.from_bytes(read(at, 4), "big")
    at += 4
    if not 1 <= keys <= 16:
        return 0
    for _ in range(keys):
        at = after(at)
        if at > most:
            return 0
    end = after(at)
    return end if end <= most and end - at - 4 >= 16 else 0


def is_token(header: str, payload: str) -> bool:
    raw = decode_base64(header)
    try:
        return raw is not None and "alg" in (h := json.loads(raw)) and isinstance(h, dict) and decode_base64(payload) is not None
    except (ValueError, TypeError, RecursionError):
        return False


def opens_object(run: str, start: int) -> bool:
    """Whether the base64 text from ``start`` decodes to the beginning of a JSON object."""
    chunk = run[start : start + 64]
    head = (decode_base64(chunk[: len(chunk) - (len(chunk) % 4 == 1)]) or b"").lstrip(b" \t\r\n")
    if not head.startswith(b"{"):
        return False
    try:
        json.JSONDecoder().raw_decode(head.decode("utf-8", "ignore"))
    except json.JSONDecodeError as e:
        return e.msg.startswith("Unterminated") or e.pos >= len(head) - 8
    except RecursionError:
        return False
    return True


def encodings(text: str, start: int, end: int) -> Iterator[tuple[int, str, int]]:
    """(start, kind, end) of the structures in a base64 run with or without line ends."""
    parts = [(c.start(1), c[1]) for c in CHARS.finditer(text, start, end) if c[1]]
    run = "".join(x for _, x in parts)
    places = [at for at, _ in parts]
    offsets = [0]
    for _, x in parts:
        offsets.append(offsets[-1] + len(x))
    after = start
    for m in BEGIN.finditer(text, start, end):
        if m.start() < after:
            continue
        i = bisect_right(places, m.start()) - 1
        if i < 0 or m.start() >= places[i] + len(parts[i][1]):
            continue
        at = offsets[i] + m.start() - places[i]
        read, most = base64_reader(run, at), (len(run) - at) * 3 // 4
        kind, size = ("der", der_key_size(read, most)) if m[0] == "M" else ("blob", container_size(read, most))
        if not size:
            continue
        last = at + -(-size * 4 // 3) - 1
        j = bisect_right(offsets, last) - 1
        after = places[j] + last - offsets[j] + 1
        after += len(text[after : after + 2]) - len(text[after : after + 2].lstrip("="))
        yield m.start(), kind, after


def pem_holds(body: str) -> bool:
    """Whether a PEM body, header lines and string quotes aside, parses or is enciphered as it says."""
    lines = re.split(r"(?:\\{1,2}r)?\\{1,2}n|[\r\n]+", body)
    plain = [re.sub(r"^[\s\"']+|[\s\"']*[+.,;]?\s*$" if quoted else r"\s+", "", x) for x in lines
             for quoted in (("\"" in x or "'" in x),) if ":" not in x]
    data = decode_base64("".join("".join(plain).split()))
    enciphered = "DEK-Info:" in body and "ENCRYPTED" in body
    return structure_of(data) is not None or (enciphered and data is not None and len(data) >= 16 and len(data) % 8 == 0)


def structure_of(data: bytes | None) -> str | None:
    """The kind of private key that fills ``data``, None if there is none."""
    if not data:
        return None
    read = bytes_reader(data)
    return "der" if der_key_size(read, len(data)) == len(data) else "blob" if container_size(read, len(data)) == len(data) else None


def secret_spans(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base, added) spans as (start, kind number, end) in code points, sorted; null text has none."""
    if not text:
        return [], []
    hexes = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18] + hexes
    added = [(m.start(), 3, m.end()) for m in JOINED.finditer(text) if is_token(m[1], m[2])]
    for s, _, e in hexes:
        if (e - s) % 2 == 0 and (kind := structure_of(bytes.fromhex(text[s:e]))):
            added.append((s, KINDS.index(kind), e))
    for m in BASE64.finditer(text):
        if kind := structure_of(decode_base64(m[0])):
            added.append((m.start(), KINDS.index(kind), m.end()))
    for m in TOKEN.finditer(text):
        header, payload = m[1], m[2]
        starts = [0, *(i.end() for i in re.finditer(r"[-_](?=e[yw])", header) if opens_object(header, i.end()))]
        if (at := next((i for i in starts if is_token(header[i:], payload)), None)) is not None:
            added.append((m.start() + at, 3, m.end()))
    for m in ANY_HEX.finditer(text):
        run = m[0]
        for i in (i.start() for i in re.finditer("(?=30)", run)):
            if size := der_key_size(hex_reader(run, i), (len(run) - i) // 2):
                added.append((m.start() + i, KINDS.index("der"), m.start() + i + 2 * size))
                break
        else:
            if len(run) % 2 == 0 and structure_of(bytes.fromhex(run)) == "blob":
                added.append((m.start(), KINDS.index("blob"), m.end()))
    for m in WRAPPED.finditer(text):
        added += [(s, KINDS.index(kind), e) for s, kind, e in encodings(text, m.start(), m.end())]
    for m in PEM.finditer(text) if "-----BEGIN" in text else ():
        if pem_holds(m[2]):
            added.append((m.start(), 6, m.end()))
    return sorted(base), sorted(set(added))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("n_assign", "n_access", "n_hex", "base", "spans")}
        for text in batch.column("text"):
            base, added = secret_spans(text.as_py())
            for i, c in enumerate(("n_assign", "n_access", "n_hex")):
                out[c].append(sum(k == i for _, k, _ in base))
            out["base"].append(_joined(base))
            out["spans"].append(_joined(sorted(base + added)))
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, t) for v, t in zip(out.values(), kinds))], names=["doc_id", *out])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_assign, n_access, n_hex, base, spans).

    ``base`` and ``spans`` list ``kind:start:end`` by start and kind, comma-joined; spans
    holds the base findings and the confirmed structures. Null and empty texts have no
    findings, repeated rows each get their row, a null id stays null, and other columns
    are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_scan, "doc_id long, n_assign long, n_access long, n_hex long, base string, spans string")
