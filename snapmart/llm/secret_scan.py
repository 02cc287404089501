"""Secret scans: patterns of known kinds, and Markov models that tell random strings from identifiers."""

import math

from pyspark.sql import Column, DataFrame, functions as F

from snapmart.llm.common import whole, written

# The kinds and patterns of the contract, the spans of each kind leftmost and non-overlapping.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ["assign", "access", "hex", "markov"]
LEAST = {"assign": 8, "access": 16, "hex": 32}

#: Characters of the strings that the Markov models judge; the bound of the models' tables is its square.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
ORDINARY = "^([A-Z]?[a-z/_-]+|[A-Z/_-]+|[0-9+/_-]+)=*$"
SMOOTHING = 0.5
#: Weight of the characters' own frequencies where a pair was seen seldom.
BACK_OFF = 8.0
#: Log-likelihood ratio from which a string counts as random: one ordinary string in about 160,000 by the model.
THRESHOLD = 12.0

SPAN = "array<struct<start:int,kind:int,end:int>>"


def spans(text: Column, pattern: str, kind: int, least: int = 0, group: int = 0) -> Column:
    """Spans of a pattern's matches whose ``group`` has ``least`` characters, as (start, kind, end) in code points.

    The pieces between the matches give the places: each match starts after all pieces and matches before it.
    """
    matches, kept = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    lengths = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"), F.transform(matches, F.length).alias("own"),
                           F.transform(kept, F.length).alias("part"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        end = begin + F.coalesce(x["own"], F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        found = F.when(x["part"] >= least, F.concat(acc["found"], F.array(span))).otherwise(acc["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    return F.when(text.rlike(pattern), F.aggregate(lengths, start, step)["found"]).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    # A run of hex digits or of an access id is long enough or fails as a whole, so the pattern itself may ask for the
    # length; an assignment's value ends the match whatever its length, so it can't.
    return F.concat(spans(text, ASSIGN, 0, LEAST["assign"], 1), spans(text, f"{ACCESS[:-1]}{{{LEAST['access'] - 4},}}", 1),
                    spans(text, f"{HEX[:-1]}{{{LEAST['hex']},}}", 2))


def cut(text: Column, span: Column) -> Column:
    return F.substr(text, span["start"] + 1, span["end"] - span["start"])


def labelled_samples(scanned: DataFrame) -> DataFrame:
    """Distinct ``_token, _random``: values inside base spans against identifiers and numbers of the whole corpus.

    Outside base spans, a candidate is labelled ordinary where it has letters of one case (or a capital at first) or digits only;
    others may be secrets themselves and have no label.
    """
    strings = scanned.select(F.explode("_strings").alias("_s")).select("_s.*").where(F.col("inside") | F.col("token").rlike(ORDINARY))
    return strings.groupBy(F.col("token").alias("_token")).agg(F.max(F.col("inside").cast("int")).alias("_random"))


def log_ratios(samples: DataFrame) -> list[float]:
    """ln P(next | character, random) - ln P(next | character, ordinary), at ``character * (size + 1) + next``.

    Counts of character pairs over all samples, backed off to the characters' own frequencies. The table has (size + 1) squared entries, whatever the corpus.
    """
    size = len(ALPHABET) + 1
    codes = F.transform(F.split("_token", ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pair = F.transform(F.sequence(F.lit(1), F.size("_codes") - 1), lambda i: F.get("_codes", i - 1) * size + F.get("_codes", i))
    counted = (samples.where(F.length("_token") > 1).select("_random", codes.alias("_codes")).select("_random", F.explode(pair).alias("_pair"))
               .groupBy("_random", "_pair").agg(F.count(F.lit(1)).alias("_n")).collect())
    counts = [[0.0] * (size * size) for _ in range(2)]
    for label, pair_code, n in counted:
        counts[label][pair_code] = n
    logs = []
    for table in counts:
        total = sum(table) + SMOOTHING * size
        alone = [(sum(table[b::size]) + SMOOTHING) / total for b in range(size)]
        rows = [sum(table[a * size:(a + 1) * size]) for a in range(size)]
        logs.append([math.log((table[a * size + b] + BACK_OFF * alone[b]) / (rows[a] + BACK_OFF)) for a in range(size) for b in range(size)])
    return [r - o for o, r in zip(*logs, strict=True)]


def log_ratio(token: Column, ratios: list[float]) -> Column:
    """Log-likelihood ratio of a string under the two Markov models."""
    table = F.split(F.lit(",".join(f"{x:.5f}" for x in ratios)), ",").cast("array<double>")
    size = len(ALPHABET) + 1
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(acc, c):
        code = F.instr(F.lit(ALPHABET), c)
        gain = F.when(acc["last"] < 0, F.lit(0.0)).otherwise(F.get(table, acc["last"] * size + code))
        return F.struct(code.alias("last"), (acc["sum"] + gain).alias("sum"))

    return F.aggregate(F.split(token, ""), start, step)["sum"]


def scan(docs: DataFrame, id_column="doc_id", text_column="text", samples: DataFrame | None = None, threshold=THRESHOLD) -> DataFrame:
    """Secrets of each document: ``n_assign, n_access, n_hex, base_sha256, spans``, and ``found``, the spans as structs.

    ``samples`` (_token, _random 0 or 1) train the Markov models; without them the corpus gives them, base
    matches against identifiers and numbers. A candidate outside base spans whose log-likelihood ratio reaches
    ``threshold`` is a span of kind ``markov``. Null and empty texts have no spans and the hash of the empty string;
    repeated rows give repeated results. No text is shuffled.
    """
    text = F.col("_text")
    outside = lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    value = lambda s: F.regexp_replace(cut(text, s), rf"^(?i:password|passwd|secret|token|api_?key)[^A-Za-z0-9+/_.-]*=?[\"']?", "")
    inside = F.transform("_base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), value(s).alias("token"), F.lit(True).alias("inside")))
    free = F.transform(F.filter("_candidates", outside), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), cut(text, s).alias("token"), F.lit(False).alias("inside")))
    scanned = (docs.select(F.col(id_column).alias("_id"), whole(text_column).alias("_text"))
               .withColumn("_base", base_spans(text)).withColumn("_candidates", spans(text, CANDIDATE, 3))
               .select("_id", "_base", F.concat(inside, free).alias("_strings")))
    scanned = written(scanned, "secret-scan")
    ratios = log_ratios(labelled_samples(scanned) if samples is None else samples)
    random = F.filter("_strings", lambda s: ~s["inside"] & (log_ratio(s["token"], ratios) >= threshold))
    added = F.transform(random, lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end")))
    names = F.array(*[F.lit(k) for k in KINDS])
    line = lambda found: F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return (scanned.withColumn("found", F.sort_array(F.concat("_base", added)))
            .select(F.col("_id").alias(id_column), *map(count, range(3)), F.sha2(line(F.sort_array("_base")), 256).alias("base_sha256"),
                    line(F.col("found")).alias("spans"), "found"))
