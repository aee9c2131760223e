"""Secret scans: known shapes, and strings that a vocabulary needs unusually many tokens for."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeline.llm import tokenizer

# The shapes of the base scan.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")

LEAST = 16
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{LEAST},}}={{0,2}}"
# Random strings also come in groups joined by dots, and with symbols that passwords take.
DOTTED = rf"[A-Za-z0-9_-]{{8,}}(?:\.[A-Za-z0-9_-]{{8,}})+"
MIXED = rf"[A-Za-z0-9+/_=!@%^*~-]{{{LEAST},}}"
# Hexadecimal digests of the usual hash functions have these many digits, in lower case.
DIGEST_DIGITS = frozenset({32, 40, 56, 64, 96, 128})
UUID = r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"

_assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_access = re.compile(ACCESS)
_hex = re.compile(HEX[:-1] + "{16,}")
_candidate = re.compile(CANDIDATE)
_uuid = re.compile(UUID)
_hexadecimal = re.compile(r"[0-9a-f]+")
_dotted = re.compile(DOTTED)
_mixed = re.compile(MIXED)
_symbol = re.compile(r"[!@%^*~]")
_part = re.compile(r"[+/_=-]+")
_unit = re.compile(rf"(?<![A-Za-z0-9]){UUID}(?![A-Za-z0-9])|[A-Za-z0-9]+")
_plain_part = re.compile(r"[A-Za-z]?[a-z]*[0-9]{0,4}|[A-Z]+[0-9]{0,4}|[0-9]+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index in KINDS, end) of the base scan, in order of start, then kind.

    Each kind's matches are leftmost and do not overlap; an assignment whose value has
    under 12 characters, an access key under 18 and a hexadecimal run under 16 are dropped.
    """
    found = [(m.start(), 0, m.end()) for m in _assign.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), 1, m.end()) for m in _access.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _hex.finditer(text)]
    return sorted(found)


def is_plain(part: str, encoder, max_ratio: float) -> bool:
    """Numbers, and words of one case with a short number: a token of the vocabulary, or made of few tokens."""
    if not _plain_part.fullmatch(part):
        return False
    word = part.rstrip("0123456789")
    tokens = len(encoder.encode_ordinary(word))
    return tokens <= 1 or len(word) > max_ratio * tokens or len(encoder.encode_ordinary(" " + word)) == 1


def is_known(string: str, encoder, max_ratio: float) -> bool:
    """Digests, UUIDs and identifiers put together from words and numbers are no secrets by themselves."""
    if _hexadecimal.fullmatch(string) and len(string) in DIGEST_DIGITS:
        return True
    return bool(_uuid.fullmatch(string)) or all(is_plain(p, encoder, max_ratio) for p in _part.split(string))


def costly_stretches(scores: list[float]) -> list[tuple[int, int]]:
    """(first, end) of the maximal stretches of positive sum: none can gain by growing, by shrinking or by joining another."""
    held: list[tuple[int, int, float, float]] = []  # first, end, sum before, sum with
    total = 0.0
    for i, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        first, start = i, before
        while True:
            k = len(held) - 1
            while k >= 0 and held[k][2] >= start:
                k -= 1
            if k < 0 or held[k][3] >= total:
                break
            first, start = held[k][0], held[k][2]
            del held[k:]
        held.append((first, i + 1, start, total))
    return [(first, end) for first, end, _, _ in held]


def costly_parts(string: str, encoder, max_ratio: float) -> list[tuple[int, int]]:
    """(start, end) of the parts between separators, or neighbouring ones together, that cost too many tokens by themselves."""
    units = list(_unit.finditer(string))
    scores = []
    for m in units:
        part = m.group()
        # Numbers, digests and UUIDs hold no secret, so they part what stands beside them.
        known = part.isdigit() or _uuid.fullmatch(part) or (_hexadecimal.fullmatch(part) and len(part) in DIGEST_DIGITS)
        scores.append(-len(part) if known else max_ratio * len(encoder.encode_ordinary(part)) - len(part))
    found = []
    for first, end in costly_stretches(scores):
        start, stop = units[first].start(), units[end - 1].end()
        if stop - start >= LEAST and not is_known(string[start:stop], encoder, max_ratio):
            found.append((start, len(string) if end == len(units) else stop))
    return found


def inefficient_spans(text: str, encoder, max_ratio: float) -> list[tuple[int, int, int]]:
    """Long strings with at most `max_ratio` characters per token that are no known digest or identifier.

    A string is judged as a whole first; if that passes, so that words beside a key could
    hide it, by its parts.
    """
    found = []
    for m in _candidate.finditer(text):
        string = m.group()
        if len(string) > max_ratio * len(encoder.encode_ordinary(string)):
            found += [(m.start() + a, 3, m.start() + b) for a, b in costly_parts(string, encoder, max_ratio)]
        elif not is_known(string, encoder, max_ratio):
            found.append((m.start(), 3, m.end()))
    for pattern, joint in ((_dotted, "."), (_mixed, None)):
        if _symbol.search(text) if joint is None else joint in text:
            found = with_joined(text, encoder, max_ratio, found, pattern, joint)
    return found


def with_joined(
    text: str, encoder, max_ratio: float, found: list[tuple[int, int, int]], pattern: re.Pattern, joint: str | None
) -> list[tuple[int, int, int]]:
    """`found`, and groups joined by dots, or strings with symbols, that hold letters and digits and cost too many tokens.

    Each group must be dear by itself, since names of packages and hosts hold cheap ones. A
    string takes the place of what was found inside it.
    """
    out: list[tuple[int, int, int]] = []
    rest = iter(sorted(found))
    following = next(rest, None)
    for m in pattern.finditer(text):
        string = m.group()
        while following and following[2] <= m.start():
            out.append(following)
            following = next(rest, None)
        inside = []
        while following and following[0] < m.end():
            inside.append(following)
            following = next(rest, None)
        whole = all(m.start() <= start and end <= m.end() for start, _, end in inside)
        mixed = any(map(str.isdigit, string)) and any(map(str.isalpha, string)) and (joint is not None or _symbol.search(string))
        groups = string.split(joint) if joint else [string]
        if whole and mixed and all(
            len(g) <= max_ratio * len(encoder.encode_ordinary(g)) and not is_known(g, encoder, max_ratio) for g in groups
        ):
            inside = [(m.start(), 3, m.end())]
        out += inside
    return out + ([following] if following else []) + list(rest)


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_spans string, spans string, "
    "redacted string"
)


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: str = tokenizer.BYTE_BPE_RANKS,
    max_ratio: float = 2.0,
    redact: bool = False,
) -> DataFrame:
    """One row per row of `docs`: counts, spans `kind:start:end` in code points, and the redacted text.

    `spans` holds the base scan's spans and, as `random`, strings of 16 characters or more
    that cost a token for every `max_ratio` characters or fewer, also as parts of a path or URL. A random string may lie
    inside a base span; base spans always stay. With `redact`, every covered stretch is
    replaced by `[SECRET]`, else `redacted` is null. A null text is an empty one: no spans.
    Rows with a null or repeated id each give a row; other columns are ignored. Every row
    is scanned alone in the task that reads it, so nothing is shuffled.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.rank_encoder(ranks)
        for batch in batches:
            counts, base_text, all_text, clean = [[], [], [], []], [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                spans = sorted(base + inefficient_spans(text, encoder, max_ratio))
                for kind, column in enumerate(counts):
                    column.append(sum(s[1] == kind for s in spans))
                base_text.append(spans_text(base))
                all_text.append(spans_text(spans))
                clean.append(cover(text, spans) if redact else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array(base_text, pa.string()),
                    pa.array(all_text, pa.string()),
                    pa.array(clean, pa.string()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_spans", "spans", "redacted"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(scan, SCHEMA)


def cover(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each stretch that spans cover, overlapping ones together, replaced by `mark`."""
    out, at, open_until = [], 0, -1
    for start, _, end in spans:
        if start >= open_until:
            out.append(text[at:start])
            out.append(mark)
        at = open_until = max(open_until, end)
    return "".join(out) + text[at:]


def redact_secrets(
    docs: DataFrame, text_col: str = "text", ranks: str = tokenizer.BYTE_BPE_RANKS, max_ratio: float = 2.0
) -> DataFrame:
    """The rows of `docs`, all columns as they are but for secrets in the text, which become `[SECRET]`; nulls stay."""

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.rank_encoder(ranks)
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            clean = [t and cover(t, sorted(base_spans(t) + inefficient_spans(t, encoder, max_ratio))) for t in texts]
            at = batch.schema.get_field_index(text_col)
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.schema.field(at).type))

    return docs.mapInArrow(redact, docs.schema)


def scan_digest(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    found = find_secrets(docs)
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_random"
    )
