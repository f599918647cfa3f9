"""Secret scans: fixed patterns, and a battery of randomness tests under false-discovery control.

The patterns give the spans of kinds assign, access and hex. Beyond them, each run of 20 or
more characters of the usual encodings that mixes digits and letters or cases is a candidate:
chi-squared uniformity over its inferred alphabet, runs and serial correlation are combined
into one value t, uniform on (0, 1) for random tokens and near 0 for words and names.

Where patterns cover part of a run, each uncovered part of 20 or more characters is a candidate
of its own.

Per encoding and length class, over all documents, candidates with t above ``SURE`` count as
random; their number tells how many random ones lie between a cutoff and ``SURE``, and what
there is beyond that counts as false. The lowest cutoff with an estimated false-discovery
rate of at most ``RATE`` holds for the class, so short classes, where the tests tell little,
get a higher cutoff than long ones. Candidates above it have the kind random.

Spans count code points of the whole text, end exclusive. Null texts count as empty; null and
repeated ids and repeated rows give a row each; an empty table gives no row; further columns
are ignored (``redacted`` keeps them).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playpulse.llm.common import id_and_text, ship_code, slices, staged
from playpulse.llm.randomness import encoding_of, randomness

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")
KINDS = ["assign", "access", "hex", "random"]
#: Texts without a match of this have no span of any kind (its case folding is wider than ASSIGN's).
ANY = r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]|[A-Za-z0-9+/_-]{20,}"
CANDIDATE = re.compile("[A-Za-z0-9+/_-]{20,}")
LEAST_LENGTH = 20
CLASSES = [24, 32, 48, 64, 128]  # upper ends of the length classes, the last one open
BINS = 100
SURE = 0.1
RATE = 0.05
LEAST = 0.001  # no cutoff is lower, so a random token passes its tests but once in a thousand

SPAN = "struct<start:int,kind:int,end:int>"
CANDIDATES = "array<struct<start:int,end:int,class:string,t:double>>"
MASK = "[SECRET]"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns, by start and kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def uncovered(a: int, b: int, spans: list[tuple[int, int, int]], at: int) -> Iterator[tuple[int, int]]:
    """The parts of a .. b outside of ``spans`` (sorted), of which those before ``at`` end before a."""
    while at < len(spans) and spans[at][0] < b:
        if a < spans[at][0]:
            yield a, spans[at][0]
        a = max(a, spans[at][2])
        at += 1
    if a < b:
        yield a, b


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, str, float]]:
    """(start, end, encoding and length class, t) of the tokens, or their parts, outside of the spans.

    Tokens and spans rise together, so a text is gone through once.
    """
    out, at, furthest = [], 0, 0
    for m in CANDIDATE.finditer(text):
        while at < len(spans) and spans[at][0] < m.start():
            furthest = max(furthest, spans[at][2])
            at += 1
        for a, b in uncovered(max(m.start(), min(furthest, m.end())), m.end(), spans, at):
            if b - a < LEAST_LENGTH:
                continue
            token = text[a:b]
            encoding = encoding_of(token)
            if encoding:
                name = f"{encoding} {sum(b - a >= c for c in CLASSES)}"
                out.append((a, b, name, randomness(token, encoding)))
    return out


def found_in(texts: pa.Array) -> tuple[list, list]:
    """Spans and candidates of each text; most texts are passed over by one scan."""
    spans: list[list] = [[] for _ in range(len(texts))]
    tokens: list[list] = [[] for _ in range(len(texts))]
    for i in pc.indices_nonzero(pc.match_substring_regex(texts, ANY)).to_pylist():
        text = texts[i].as_py()
        spans[i] = base_spans(text)
        tokens[i] = candidates(text, spans[i])
    return spans, tokens


def scanned(docs: DataFrame) -> DataFrame:
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    token = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("class", pa.string()), ("t", pa.float64())]))

    def scan(batches):
        for part in slices(batches, "text"):
            spans, tokens = found_in(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([[dict(zip(("start", "kind", "end"), s, strict=True)) for s in x] for x in spans], span),
                    pa.array([[dict(zip(("start", "end", "class", "t"), c, strict=True)) for c in x] for x in tokens], token),
                ],
                ["doc_id", "base", "tokens"],
            )

    return docs.mapInArrow(scan, f"doc_id long, base array<{SPAN}>, tokens {CANDIDATES}")


def choose_cutoffs(found: DataFrame, rate: float = RATE) -> dict[str, float]:
    """The cutoff on t of each encoding and length class (a bounded number of them); 1 where none will do."""
    tokens = found.select(F.explode("tokens").alias("x"))
    bin_of = F.least(F.floor(F.col("x.t") * BINS), F.lit(BINS - 1)).cast("int")
    rows = tokens.where(F.col("x.t") >= LEAST).groupBy(F.col("x.class").alias("class"), bin_of.alias("bin")).agg(F.count("*").alias("n"))
    counts: dict[str, list[int]] = {}
    for r in rows.collect():  # BINS rows a class at most
        counts.setdefault(r["class"], [0] * BINS)[r["bin"]] = r["n"]
    out = {}
    for name, n in counts.items():
        sure = round(SURE * BINS)
        upper = sum(n[sure:])
        out[name] = 1.0
        for cut in range(sure + 1):
            above = sum(n[cut:])
            false = above - upper * (BINS - cut) / (BINS - sure)
            if above and upper and false <= rate * above:
                out[name] = max(LEAST, cut / BINS)
                break
    return out


def passed(tokens: Column, cutoffs: dict[str, float]) -> Column:
    if not cutoffs:
        return F.slice(tokens, 1, 0)
    of = F.create_map(*[F.lit(x) for pair in cutoffs.items() for x in pair])
    return F.filter(tokens, lambda x: x["t"] >= F.coalesce(F.element_at(of, x["class"]), F.lit(2.0)))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of every row."""
    ship_code(docs.sparkSession)
    found = staged(scanned(id_and_text(docs, id_col, text_col)), "secrets")
    random = F.transform(
        passed(F.col("tokens"), choose_cutoffs(found, rate)),
        lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("kind"), x["end"].alias("end")),
    )
    names = F.array(*map(F.lit, KINDS))
    listed = lambda spans: F.array_join(
        F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat(F.col("base"), random)).alias("spans"),
        F.size(random).cast("long").alias("n_random"),
    )


def masked(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` with every span, overlapping ones together, replaced by the mask."""
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", rate: float = RATE) -> DataFrame:
    """``docs`` with all rows and columns, secrets in the texts replaced by a mask, ``length_col`` brought up to date.

    Null texts stay null, texts without a secret and their lengths stay as they are.
    """
    ship_code(docs.sparkSession)
    found = staged(scanned(docs.select(F.lit(None).cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))).where("size(tokens) > 0"), "secret-tokens")
    cutoffs = choose_cutoffs(found, rate)
    text_at = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col in docs.columns else None

    def mask(batches):
        for part in slices((b.rename_columns([str(i) for i in range(b.num_columns)]) for b in batches), str(text_at)):
            texts = part.column(text_at)
            spans, tokens = found_in(pc.fill_null(texts, ""))
            hit = {
                i: [(a, b) for a, _, b in x] + [(a, b) for a, b, c, t in y if t >= cutoffs.get(c, 2.0)]
                for i, (x, y) in enumerate(zip(spans, tokens, strict=True)) if x or y
            }
            hit = {i: s for i, s in hit.items() if s}
            columns = list(part.columns)
            if hit:
                values = texts.to_pylist()
                for i, s in hit.items():
                    values[i] = masked(values[i], s)
                columns[text_at] = pa.array(values, texts.type)
                if length_at is not None:
                    lengths = columns[length_at].to_pylist()
                    for i in hit:
                        lengths[i] = len(values[i])
                    columns[length_at] = pa.array(lengths, columns[length_at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    names = docs.columns
    return docs.mapInArrow(mask, docs.schema)
