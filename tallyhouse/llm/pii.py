"""Personal data: known shapes, and identifiers found by bootstrapped contexts. Spark SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

# The shapes, as regular expressions whose matches are exactly the leftmost, non-overlapping,
# non-failing matches of the plain ones. Look-behinds keep every attempt linear: a match
# begins where a run of its characters begins, or where the previous match ended (\G).
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
#: What may be an identifier of an unknown shape: five or more letters and digits with two digits, or an address.
CANDIDATE = r"(?<![\p{L}\p{N}_@])(?=[\p{L}_./@-]*+[0-9])[\p{L}\p{N}]++(?:[._/@-][\p{L}\p{N}]++)*+"

#: Rounds of scoring; a pattern needs SEEDS different known entities and CONFIDENCE to discover anything.
ROUNDS = 3
SEEDS = 3
CONFIDENCE = 0.8
ACCEPT = 0.9
#: Characters of context to the left of a candidate.
CONTEXT = 40
_BLOCK = 512

_MARK, _OTHER = "\\u0001", "\\u0002"


def _parts(text: str, pattern: str) -> str:
    """SQL: a text cut at all matches: between, match, between, match ... between.

    The mark that separates them is first replaced where the text has it by another
    character that no pattern knows, so lengths and matches stay.
    """
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    return f"split(regexp_replace(translate({text}, '{_MARK}', '{_OTHER}'), '({quoted})', '{_MARK}$1{_MARK}'), '{_MARK}', -1)"


def _ends(parts: str) -> str:
    """SQL: running ends of the parts, in code points.

    Built in blocks, so that the copying of growing arrays stays far below the square of the matches.
    """
    block = f"aggregate(slice({parts}, i * {_BLOCK} + 1, {_BLOCK}), cast(array() as array<bigint>), (a, x) -> concat(a, array(coalesce(try_element_at(a, -1), 0L) + char_length(x))))"
    blocks = f"transform(sequence(0, cast((size({parts}) - 1) div {_BLOCK} as int)), i -> {block})"
    return f"aggregate({blocks}, cast(array() as array<bigint>), (a, b) -> concat(a, transform(b, x -> x + coalesce(try_element_at(a, -1), 0L))))"


def _luhn(digits: str) -> str:
    """SQL: whether the checksum of a string of digits is a multiple of ten."""
    digit = f"cast(substr({digits}, length({digits}) - i + 1, 1) as int)"
    return f"aggregate(sequence(1, length({digits})), 0, (s, i) -> s + if(i % 2 = 1, {digit}, 2 * {digit} - if({digit} > 4, 9, 0))) % 10 = 0"


_VALID = {
    "email": "true",
    "ip": "forall(split(m.value, '[.]'), x -> length(ltrim('0', x)) <= 3 and cast('0' || right(ltrim('0', x), 3) as int) <= 255)",
    "card": _luhn("regexp_replace(m.value, '[ -]', '')"),
    "phone": "length(regexp_replace(m.value, '[^0-9]', '')) between 8 and 15",
}
# cheap tests that a text must pass before a pattern is tried at all
_GATE = {
    "email": "contains(text, '@')",
    "ip": "text rlike '[0-9][.][0-9]'",
    "card": "text rlike '[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]'",
    "phone": "contains(text, '+')",
}
_SPAN = "array<struct<start: bigint, end: bigint, value: string, before: string>>"


def _matches(pattern: str, gate: str) -> Column:
    """All matches of a pattern in `text`, with their places and the text just before them."""
    parts = "t.parts"
    cut = f"transform(array(struct({_parts('text', pattern)} as parts)), t -> struct(t.parts as parts, {_ends(parts)} as ends))"
    match = (
        "struct(element_at(c.ends, 2 * i - 1) as start, element_at(c.ends, 2 * i) as end, element_at(c.parts, 2 * i) as value, "
        f"right(element_at(c.parts, 2 * i - 1), {CONTEXT}) as before)"
    )
    found = f"flatten(transform({cut}, c -> if(size(c.parts) < 3, cast(array() as {_SPAN}), transform(sequence(1, cast(size(c.parts) div 2 as int)), i -> {match}))))"
    return F.expr(f"if({gate}, {found}, cast(array() as {_SPAN}))")


def base_spans(documents: DataFrame) -> DataFrame:
    """doc_id, text and the valid matches of each kind."""
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    shapes = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True))
    docs = docs.withColumns({kind: _matches(shapes[kind], _GATE[kind]) for kind in KINDS})
    return docs.withColumns({kind: F.expr(f"filter({kind}, m -> {_VALID[kind]})") for kind in KINDS})


def _list(kind: str) -> str:
    return f"array_join(transform({kind}, m -> concat_ws(':', '{kind}', m.start, m.end)), ',')"


def discover(occurrences: DataFrame, rounds: int = ROUNDS, seeds: int = SEEDS, confidence: float = CONFIDENCE) -> DataFrame:
    """(row, start, end): candidates that confident patterns mark, from (row, start, end, value, pattern, seed).

    The graph has an edge from each pattern to each of its values. Round by round a pattern's
    confidence is the mean reliability of its different values, where a seed counts 1 and any
    other value 1 less the product of its patterns' doubts so far; a pattern with fewer
    than `seeds` different seeds has none. All steps are grouped aggregates over the edges.
    """
    edges = written(occurrences.groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "edges")
    reliable = edges.withColumn("r", F.when(F.col("seed"), 1.0).otherwise(0.0))
    scores = None
    for _ in range(rounds):
        scores = reliable.groupBy("pattern").agg(F.avg("r").alias("mean"), F.sum(F.col("seed").cast("int")).alias("seeds"))
        scores = scores.where(F.col("seeds") >= seeds).select("pattern", "mean")
        values = edges.join(scores, "pattern").groupBy("value").agg((1 - F.exp(F.sum(F.log(1.0001 - F.col("mean"))))).alias("belief"))
        joined = edges.join(values, "value", "left")
        reliable = written(joined.withColumn("r", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("belief", F.lit(0.0)))).select("pattern", "value", "seed", "r"), "scores")
    sure = reliable.where((F.col("r") >= ACCEPT) & ~F.col("seed")).select("value").distinct()
    trusted = scores.where(F.col("mean") >= confidence).select("pattern")
    return occurrences.where(~F.col("seed")).join(trusted, "pattern", "left_semi").join(sure, "value", "left_semi").select("row", "start", "end")


def personal_data(documents: DataFrame, rounds: int = ROUNDS, seeds: int = SEEDS, confidence: float = CONFIDENCE) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context.

    Valid matches of the known shapes are seeds. The two words before them are patterns; strings with digits that stand in the same patterns are candidates. The
    pattern graph is scored over all documents, and candidates that
    confident patterns mark are spans of kind `context`.

    Only texts with a digit are searched for candidates. Null and empty texts have no span; repeated rows
    are repeated results; other columns are not read. A candidate that overlaps a seed is none. A pattern is two words of at
    most 20 characters, so longer words make none. Very long texts are searched whole; their matches are sorted by
    place, not compared with each other.
    """
    found = base_spans(documents).withColumn("candidates", _matches(CANDIDATE, "text rlike '[0-9]'"))
    # written once, without the texts, and read by all that follows
    found = written(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", *KINDS, "candidates"), "matches")
    known = found.select("row", F.explode(F.concat(*KINDS)).alias("m")).select("row", "m.*", F.lit(True).alias("seed"))
    other = found.select("row", F.explode(F.expr("filter(candidates, c -> length(c.value) >= 5)")).alias("m")).select("row", "m.*", F.lit(False).alias("seed"))
    # the furthest end of the seeds that begin before or with a match, and the next begin of one after or with it
    up, down = (Window.partitionBy("row").orderBy(o).rangeBetween(Window.unboundedPreceding, 0) for o in (F.col("start"), F.col("start").desc()))
    both = known.unionByName(other)
    both = both.withColumn("reach", F.max(F.when(F.col("seed"), F.col("end"))).over(up)).withColumn("next", F.min(F.when(F.col("seed"), F.col("start"))).over(down))
    overlaps = F.coalesce(F.col("reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("next") < F.col("end"), F.lit(False))
    both = both.where(F.col("seed") | ~overlaps)
    words = F.regexp_extract("before", r"(\S{1,20}\s{1,3}\S{1,20})\s{0,3}\z", 1)
    pattern = F.lower(F.regexp_replace(words, r"[^\p{L}\p{N}:=#]+", " "))
    both = both.withColumn("pattern", pattern).where(F.length("pattern") > 2)
    occurrences = written(both.select("row", "start", "end", "value", "pattern", "seed"), "occurrences")
    marked = discover(occurrences, rounds, seeds, confidence).distinct()
    more = marked.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("context"))
    rows = found.select(
        "row", "doc_id", *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.expr("array_join(filter(array(" + ", ".join(map(_list, KINDS)) + "), x -> x <> ''), ',')").alias("base"),
    )
    out = rows.join(more, "row", "left")
    context = F.expr("array_join(transform(coalesce(context, cast(array() as array<struct<start: bigint, end: bigint>>)), m -> concat_ws(':', 'context', m.start, m.end)), ',')")
    return out.select(
        "doc_id", *(f"n_{kind}" for kind in KINDS), F.sha2("base", 256).alias("base_sha256"),
        F.array_join(F.filter(F.array("base", context), lambda x: x != ""), ",").alias("spans"),
        F.coalesce(F.size("context"), F.lit(0)).cast("long").alias("n_context"),
    )
