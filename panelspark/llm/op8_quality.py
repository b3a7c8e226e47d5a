"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document. Its measurement and one failure
bit are stored; a policy is a versioned set of rules, that is a mask. Verdicts
and ablations of any policy come from the stored bits without touching text.

Defined cases: null text has no words (as empty text: it fails the word count);
texts of any length are processed whole; repeated rows each get their own
verdict; an empty table gives an empty ledger; all input columns are kept and
the ledger is one struct column, renamed if its name is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import computed_once, free_name, split_words

WINDOW = 5

#: Rules in bit order: name, and the SQL condition over the measurements under which a document fails.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "10 * n_dup_lines > 6 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("shouting", "2 * n_upper > word_chars"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: Policies by version: the rules that reject.
POLICIES = {
    "v1": ("few_words", "repeated_windows"),
    "v2": tuple(name for name, _ in RULES),
}
PRODUCTION = "v2"


def mask_of(policy: str) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def _size(array: Column) -> Column:
    return F.size(array).cast("bigint")


def measure(df: DataFrame, text: str) -> tuple[DataFrame, list[str]]:
    """Adds the measurements; returns the frame and the names of the added columns."""
    t = F.coalesce(F.col(text), F.lit(""))
    names = {k: free_name(df, f"q_{k}") for k in ("words", "hashes", "keys", "sorted", "where", "lines")}
    c = {k: F.col(v) for k, v in names.items()}
    out = df.withColumns({
        names["words"]: split_words(F.col(text)),
        names["lines"]: F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    }).withColumn(names["hashes"], F.transform(c["words"], lambda w: F.xxhash64(w)))
    n_windows = F.size(c["hashes"]) - (WINDOW - 1)
    out = out.withColumn(names["keys"], F.when(n_windows > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(n_windows, F.lit(1)) - 1),
        lambda i: F.xxhash64(*(F.get(c["hashes"], i + j) for j in range(WINDOW))))))
    # Positions of windows that occur twice or more, ascending; most texts have none and skip the second sort.
    pairs = F.sort_array(F.transform(c["keys"], lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    out = out.withColumn(names["sorted"], F.when(F.size(F.array_distinct(c["keys"])) < F.size(c["keys"]), pairs))
    same = lambda i, j: F.coalesce(F.get(c["sorted"], i)["k"] == F.get(c["sorted"], j)["k"], F.lit(False))
    out = out.withColumn(names["where"], F.sort_array(F.transform(
        F.filter(c["sorted"], lambda p, i: same(i, i - 1) | same(i, i + 1)), lambda p: p["i"])))
    gaps = F.transform(c["where"], lambda p, i: F.least(F.coalesce(F.get(c["where"], i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    values = {
        "n_words": _size(c["words"]),
        "word_chars": F.length(F.array_join(c["words"], "")).cast("bigint"),
        "n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("bigint"),
        "n_lines": _size(c["lines"]),
        "n_dup_lines": _size(c["lines"]) - _size(F.array_distinct(c["lines"])),
        "n_repeat_words": F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("bigint"),
        "n_upper": F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("bigint"),
    }
    made = {k: free_name(out, k) for k in values}
    return out.withColumns({made[k]: v for k, v in values.items()}).drop(*names.values()), list(made.items())


def ledger(df: DataFrame, text: str = "text", out: str = "ledger") -> DataFrame:
    """Input columns plus one struct: the measurements and `failure_bits`."""
    measured, names = measure(df, text)
    fields = [F.col(col).alias(k) for k, col in names]
    out = free_name(df, out)
    measured = measured.withColumn(out, F.struct(*fields)).select(*df.columns, out)
    bits = [F.when(F.expr(_qualified(rule, out, names)), F.lit(BIT[name]).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
            for name, rule in RULES]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return computed_once(measured.withColumn(out, F.col(out).withField("failure_bits", total)), out)


def _qualified(rule: str, out: str, names) -> str:
    for k, _ in names:
        rule = rule.replace(k, f"`{out}`.{k}")
    return rule


def verdict(bits: Column, policy: str = PRODUCTION) -> Column:
    """True if no rule of the policy failed."""
    return bits.bitwiseAND(F.lit(mask_of(policy))) == 0


def ablation(ledgers: DataFrame, bits: Column, policy: str = PRODUCTION, by: tuple[str, ...] = ()) -> DataFrame:
    """Per rule of the policy (and group): documents that fail it, and documents that only this rule rejects,
    that is those which come back if the rule is taken out. Works on the histogram of the failure bits, which
    has at most 2^rules rows a group, so text and documents are aggregated map-side only once."""
    m = mask_of(policy)
    hist = ledgers.groupBy(*by, bits.bitwiseAND(F.lit(m)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).cast("bigint").alias("bit")) for n in POLICIES[policy]))
    rows = hist.select(*by, "bits", "n", F.explode(rules).alias("r"))
    n_if = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("bigint")
    return rows.groupBy(*by, F.col("r.rule").alias("rule")).agg(
        n_if(F.col("bits").bitwiseAND(F.col("r.bit")) != 0).alias("n_failed"),
        n_if(F.col("bits") == F.col("r.bit")).alias("n_only_this_rule"))


def keep_good(df: DataFrame, text: str = "text", policy: str = PRODUCTION) -> DataFrame:
    """The rows whose text no rule of the policy rejects; same columns."""
    out = free_name(df, "ledger")
    return ledger(df, text, out).filter(verdict(F.col(f"`{out}`.failure_bits"), policy)).select(*df.columns)
