"""Secret scanning with corpus-wide ownership, in DataFrame functions only.

Base kinds (assign, access, hex) are always reported.  Candidates of further kinds (vendor keys,
JSON web tokens, private keys, passwords in addresses, opaque tokens) are reported if the corpus
says so: the value of every candidate is hashed and counted by distinct repositories and owners.
A value held by more than ``max_owners`` owners is a widely copied *example*; one of few owners
that looks random is *live*; the rest is weak.  Only live further candidates outside base spans
become spans.  Where candidates overlap, the live ones of the first kind in ``FURTHER`` take the place, so that
a weak or example candidate hides nothing; example ones count outside those.

Counting needs no text: rows of hashes are pre-aggregated to distinct (hash, repository, owner),
so a value in a third of all rows is a few rows per task.  An owner is the part of the
repository's name before the first ``/``.

Spans are (kind, start, end) in code points, end exclusive.  Defined cases: a null text counts as
empty and has no spans; a null repository is a repository and an owner of its own; documents are
told apart by id and text, so repeated rows each get the same result and a null id is allowed.  Other columns
pass through; columns named in ``MADE`` are replaced.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import let, set_aside, text_keys, text_of
from termloom.sources.shared import materialize

MADE = ["spans", "n_live", "n_example"]
KEYS = ["doc_id", "_k1", "_k2"]
# Names used beside a table's own columns, which are set aside under such names.
HELPERS = ["spans", "_k1", "_k2", "_base", "_more", "_live", "_example", *(f"_of{k}" for k in KEYS)]
SPAN = "struct<start:bigint,kind:int,end:bigint,hash:bigint,random:boolean>"
MARK = "<secret>"

# The base kinds, each with its pattern, the group of the value, and the least
# length of the match (assign: of the value).
BASE = {
    "assign": (
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        8,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
# The same for the further kinds: published forms of credentials.
FURTHER = {
    "vendor": (
        r"(gh[pousr]_[A-Za-z0-9]{20,}|glpat-[A-Za-z0-9_-]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}"
        r"|[sr]k_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{30,}|npm_[A-Za-z0-9]{30,})",
        0,
        14,
    ),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 29),
    "private": (
        r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?:\s{1,64}[A-Za-z][A-Za-z0-9-]*+:[^\r\n]*+){0,64}"
        r"[A-Za-z0-9+/=\s]{16,}",
        0,
        40,
    ),
    "url": (r"[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s/:@]{1,64}:([^\s/:@]{6,128})@", 1, 6),
    "opaque": (r"[A-Za-z0-9+/_-]{24,}", 0, 24),
}
KINDS = {**BASE, **FURTHER}
NUMBER = {kind: i for i, kind in enumerate(KINDS)}
WORDS = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|123456"
PLACEHOLDER = WORDS + r"|x{6,}|(.)\1{5,}"
# Runs of one letter are part of every key of some formats: base64 of zeros.
ENCODED = ("jwt", "private")
# What is the same in private keys: the first line and header lines.
ARMOR = r"-----BEGIN [A-Z ]*PRIVATE KEY-----|(?m)^\s*[A-Za-z][A-Za-z0-9-]*:.*$"


@dataclass(frozen=True)
class Ownership:
    """``max_owners``: most owners of a live value.  ``min_distinct``: fewest different
    characters of a value that looks random."""

    max_owners: int = 3
    min_distinct: int = 10


def _random_looking(kind: str, value: Column, rules: Ownership) -> Column:
    if kind == "private":
        value = F.regexp_replace(value, ARMOR, "")
    different = F.size(F.array_distinct(F.split(value, "")))
    good = (different >= rules.min_distinct) & ~value.rlike(WORDS if kind in ENCODED else PLACEHOLDER)
    if kind == "opaque":
        good = good & value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")
    return good


def find(text: Column, kind: str, rules: Ownership) -> Column:
    """Array of ``SPAN``: leftmost matches that do not overlap, long enough ones only.

    The pieces between the matches give the positions.
    """
    pattern, group, least = KINDS[kind]
    none = F.array().cast(f"array<{SPAN}>")
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    pieces = F.zip_with(
        F.arrays_zip(F.split(text, pattern, -1).alias("before"), whole.alias("whole")),
        value,
        lambda a, b: F.struct(a["before"].alias("before"), a["whole"].alias("whole"), b.alias("value")),
    )

    def step(state, x):
        start = state["at"] + F.length(x["before"])
        end = start + F.length(x["whole"])
        v = x["value"]
        span = F.struct(
            start, F.lit(NUMBER[kind]), end, F.xxhash64(v), _random_looking(kind, v, rules)
        ).cast(SPAN)
        measured = v if kind in ("assign", "url") else x["whole"]
        out = F.when(
            F.length(measured) >= least, F.concat(state["out"], F.array(span))
        ).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out")).cast(f"struct<at:bigint,out:array<{SPAN}>>")

    start = F.struct(F.lit(0).alias("at"), none.alias("out")).cast(
        f"struct<at:bigint,out:array<{SPAN}>>"
    )
    matches = F.filter(pieces, lambda x: x["whole"].isNotNull())
    return F.when(text.rlike(pattern), F.aggregate(matches, start, step, lambda s: s["out"])).otherwise(none)


def _outside(spans: Column, others: Column) -> Column:
    def apart(o):
        return lambda x: ~F.exists(o, lambda y: (x["start"] < y["end"]) & (y["start"] < x["end"]))

    return let(others, lambda o: F.filter(spans, apart(o)))


def with_candidates(docs: DataFrame, text_column: str, rules: Ownership) -> DataFrame:
    """Adds ``_base`` and ``_more`` (arrays of ``SPAN``, sorted) and the document's keys."""
    text = text_of(text_column)
    k1, k2 = text_keys(text)

    def both(kinds):
        return F.array_sort(reduce(F.concat, [find(text, k, rules) for k in kinds]))

    df = docs.withColumns({"_k1": k1, "_k2": k2, "_base": both(BASE)})
    # Those of different kinds may overlap until it is known which are live.
    return df.withColumn("_more", _outside(both(FURTHER), F.col("_base")))


def _taken(spans: Column, taken: Column) -> Column:
    """``taken`` and those of ``spans`` outside it, each kind in turn, so that kinds do not overlap."""

    def of(kind):
        return F.filter(spans, lambda s: s["kind"] == NUMBER[kind])

    return reduce(
        lambda before, kind: let(before, lambda t: F.concat(t, _outside(of(kind), t))), FURTHER, taken
    )


def ownership(found: DataFrame, repository: str, rules: Ownership) -> DataFrame:
    """``(hash, repositories, owners, state)`` of every candidate value of the corpus."""
    repo = F.coalesce(F.col(repository).cast("string"), F.lit(""))
    rows = found.select(
        repo.alias("repo"), F.explode(F.concat("_base", "_more")).alias("s")
    ).select("repo", F.substring_index("repo", "/", 1).alias("owner"), "s.hash", "s.random")
    owned = rows.groupBy("hash", "repo", "owner").agg(F.max("random").alias("random"))
    per_owner = owned.groupBy("hash", "owner").agg(
        F.count("*").alias("repositories"), F.max("random").alias("random")
    )
    counted = per_owner.groupBy("hash").agg(
        F.sum("repositories").alias("repositories"),
        F.count("*").alias("owners"),
        F.max("random").alias("random"),
    )
    state = (
        F.when(F.col("owners") > rules.max_owners, "example")
        .when(F.col("random"), "live")
        .otherwise("weak")
    )
    return counted.select("hash", "repositories", "owners", state.alias("state"))


def _judged(found: DataFrame, values: DataFrame) -> DataFrame:
    """Per document: the live further spans and the number of live and example candidates."""
    rows = found.select(*KEYS, F.explode(F.concat("_base", "_more")).alias("s")).distinct()
    rows = rows.withColumn("hash", F.col("s.hash")).join(values.select("hash", "state"), "hash")
    live, example = F.col("state") == "live", F.col("state") == "example"
    further = F.col("s.kind") >= len(BASE)
    per_document = rows.groupBy(*(F.col(k).alias(f"_of{k}") for k in KEYS)).agg(
        F.collect_list(F.when(live & further, F.col("s"))).alias("_live"),
        F.collect_list(F.when(example & further, F.col("s"))).alias("_example"),
        F.count_if(live & ~further).alias("n_live"),
        F.count_if(example & ~further).alias("n_example"),
    )
    none = F.array().cast(f"array<{SPAN}>")
    placed = per_document.withColumn("_live", _taken(F.col("_live"), none))
    both = F.size(_taken(F.col("_example"), F.col("_live")))
    return placed.select(
        *(f"_of{k}" for k in KEYS),
        "_live",
        (F.col("n_live") + F.size("_live")).alias("n_live"),
        (F.col("n_example") + both - F.size("_live")).alias("n_example"),
    )


def _same_document(a: DataFrame, b: DataFrame) -> Column:
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[f"_of{k}"]) for k in KEYS))


def scan(
    docs: DataFrame,
    text_column: str = "text",
    repository: str = "source",
    rules: Ownership | None = None,
) -> DataFrame:
    """``docs`` without the text, with ``base_spans`` and ``MADE``; needs a column doc_id."""
    rules = rules or Ownership()
    docs, back = set_aside(docs.drop(*MADE, "base_spans"), HELPERS)
    found = with_candidates(docs, text_column, rules).drop(text_column)
    found = materialize(found, "secret-candidates")
    values = ownership(found, repository, rules)
    judged = _judged(found.filter(F.size("_base") + F.size("_more") > 0), values)
    df = found.join(judged, _same_document(found, judged), "left")
    none = F.array().cast(f"array<{SPAN}>")
    spans = F.array_sort(F.concat("_base", F.coalesce("_live", none)))
    return df.select(
        *(found[c] for c in docs.columns if c != text_column),
        F.col("_base").alias("base_spans"),
        spans.alias("spans"),
        *(F.coalesce(judged[c], F.lit(0)).cast("bigint").alias(c) for c in MADE[1:]),
    ).withColumnsRenamed(back)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by ``MARK``."""
    kind = "struct<at:bigint,out:string>"

    def step(state, s):
        gap = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        out = F.when(s["start"] >= state["at"], F.concat(state["out"], gap, F.lit(MARK)))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            out.otherwise(state["out"]).alias("out"),
        ).cast(kind)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast(kind)
    rest = F.aggregate(
        spans,
        start,
        step,
        lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))),
    )
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def redact(
    docs: DataFrame, repository: str = "source", rules: Ownership | None = None
) -> DataFrame:
    """``docs`` with every reported span replaced, and ``n_chars`` made anew.

    The candidates are found once and stored without the texts; the texts meet the spans to
    replace in one join.
    """
    rules = rules or Ownership()
    own, back = set_aside(docs, HELPERS)
    found = with_candidates(own, "text", rules)
    narrow = found.select(*dict.fromkeys([*KEYS, repository]), "_base", "_more")
    narrow = materialize(narrow, "secret-candidates").filter(F.size("_base") + F.size("_more") > 0)
    judged = _judged(narrow, ownership(narrow, repository, rules))
    none = F.array().cast(f"array<{SPAN}>")
    base = narrow.select(*KEYS, "_base").distinct()
    spans = base.join(judged, _same_document(base, judged), "left").select(
        *(base[k].alias(f"_of{k}") for k in KEYS),
        F.array_sort(F.concat("_base", F.coalesce("_live", none))).alias("spans"),
    )
    spans = materialize(spans.filter(F.size("spans") > 0), "secret-spans")
    k1, k2 = text_keys(text_of())
    keyed = own.withColumns({"_k1": k1, "_k2": k2})
    df = keyed.join(spans, _same_document(keyed, spans), "left")
    hit = F.col("spans").isNotNull()
    df = df.withColumn("text", F.when(hit, redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        made = F.when(hit, F.length("text").cast("bigint"))
        df = df.withColumn("n_chars", made.otherwise(F.col("n_chars")))
    return df.select(own.columns).withColumnsRenamed(back)
