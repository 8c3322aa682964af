"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger holds the measurements and one bit per failed rule; a policy is a named,
versioned set of rules, so that applying one, comparing two or leaving a rule out needs bit operations on the ledger and not the
texts. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import indices, once

GAPS = r"[\x20\x09-\x0D]+"
WINDOW = 5

#: Rules in the order of their bits; a condition over the measurements that a failing document meets.
RULES = {
    "few_words": lambda m: m["n_words"] < 10,
    "repeated_windows": lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"],
    "symbols": lambda m: 10 * m["n_symbols"] > m["n_words"],
    "duplicate_lines": lambda m: 100 * m["n_dup_lines"] > 40 * m["n_lines"],
    "word_length": lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"]),
    "capitals": lambda m: 2 * m["n_capitals"] > m["word_chars"],
    "exclamations": lambda m: 10 * m["n_exclamations"] > 3 * m["n_words"],
    "stutter": lambda m: 100 * m["n_stutter"] > 20 * m["n_words"],
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_exclamations", "n_stutter")

#: Versions of policies, each a list of the rules that reject.
POLICIES = {
    "base": ["few_words", "repeated_windows"],
    "2024.1": ["few_words", "repeated_windows", "symbols", "duplicate_lines"],
    "2024.2": list(RULES),
}


def _repeated_words(words: Column, n: Column) -> Column:
    """Words within windows whose text occurs twice or more: sort the windows, take those equal to a neighbour, unite their ranges."""
    windows = F.sort_array(F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("text"), i.alias("at"))))

    def covered(found: Column) -> Column:
        text = lambda i: F.get(found, i)["text"]
        again = F.filter(F.sequence(F.lit(0), F.size(found) - 1), lambda i: F.coalesce(text(i) == text(i - 1), F.lit(False)) | F.coalesce(text(i) == text(i + 1), F.lit(False)))
        starts = F.transform(again, lambda i: F.get(found, i)["at"])
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda at: F.sequence(at, at + (WINDOW - 1))))))

    return once(windows, covered)


def _measures(text: Column) -> Column:
    """All measurements of a text as one struct. Intermediate values are lambda arguments, so that no optimizer rule can copy the
    expressions behind them into a loop over the words."""
    parts = F.struct(
        text.alias("text"), F.array_remove(F.split(text, GAPS), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))

    def measure(p: Column) -> Column:
        words, n, whole = p["words"], F.size(p["words"]), p["text"]
        # Different hashes prove that no window is repeated; only the other documents compare the windows themselves.
        hashes = F.transform(indices(0, n - WINDOW), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
        values = {
            "n_words": n,
            "word_chars": F.char_length(F.array_join(words, "")),
            "n_symbols": F.regexp_count(whole, F.lit(r"[#*$%&|<>]")),
            "n_lines": F.size(p["lines"]),
            "n_dup_lines": F.size(p["lines"]) - F.size(F.array_distinct(p["lines"])),
            "n_repeat_words": once(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_repeated_words(words, n))),
            "n_capitals": F.regexp_count(whole, F.lit(r"\p{Lu}")),
            "n_exclamations": F.regexp_count(whole, F.lit("!")),
            "n_stutter": F.size(F.filter(indices(1, n - 1), lambda i: F.get(words, i) == F.get(words, i - 1))),
        }
        return F.struct(*(value.cast("long").alias(name) for name, value in values.items()))

    return once(parts, measure)


def _failures(measures: Column) -> Column:
    """The measurements with failure_bits: bit i is set where rule i of RULES fails."""
    def add(m: Column) -> Column:
        bits = F.lit(0)
        for name, condition in RULES.items():
            bits = bits.bitwiseOR(F.when(condition(m), BITS[name]).otherwise(0))
        return F.struct(*(m[name].alias(name) for name in MEASURES), bits.alias("failure_bits"))

    return once(measures, add)


def ledger(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Return `row` (the whole input row) and `ledger`: the measurements of its text and failure_bits.

    A null or empty text measures 0 everywhere. Repeated rows are measured one by one; clashing column names stay inside `row`.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(F.struct("*").alias("row"), _failures(_measures(text)).alias("ledger"))


def policy_mask(version: str) -> int:
    return sum(BITS[name] for name in POLICIES[version])


def passes(*versions: str) -> Column:
    """Whether a row of a ledger fails no rule of the policies."""
    mask = 0
    for version in versions:
        mask |= policy_mask(version)
    return F.col("ledger.failure_bits").bitwiseAND(mask) == 0


def ablations(rows: DataFrame, version: str) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail no other rule of the policy, and that stay rejected without it.

    One aggregation over the ledger's bits; a ledger that is stored is not measured again. An empty ledger counts 0 everywhere.
    """
    mask = policy_mask(version)
    bits = F.col("ledger.failure_bits").bitwiseAND(mask)
    sums = [F.struct(
        F.lit(name).alias("rule"),
        F.count_if(bits.bitwiseAND(BITS[name]) != 0).alias("n_failed"),
        F.count_if(bits == BITS[name]).alias("n_only"),
        F.count_if(bits.bitwiseAND(mask & ~BITS[name]) != 0).alias("n_rejected_without"),
    ) for name in POLICIES[version]]
    return rows.agg(F.array(*sums).alias("rules")).select(F.inline("rules"))


def quality_rules(docs: DataFrame, version: str = "2024.2", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return id, the measurements, failure_bits, base_failed (the policy "base" rejects) and kept (no rule of both policies fails)."""
    return ledger(docs, text_column).select(F.col(f"row.{id_column}").alias(id_column), "ledger.*", (~passes("base")).alias("base_failed"), passes("base", version).alias("kept"))


def keep_good(docs: DataFrame, version: str = "2024.2", text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, that neither the base rules nor the policy reject."""
    return ledger(docs, text_column).filter(passes("base", version)).select("row.*")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS k FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
pos AS (SELECT k, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5),
win AS (SELECT k, i, count(*) OVER (PARTITION BY k, list_slice(ws, i, i + 4)) AS n FROM pos),
cov AS (SELECT k, count(DISTINCT i + j) AS n_repeat_words FROM win, range(0, 5) r(j) WHERE n > 1 GROUP BY k),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(regexp_extract_all(t, '\p{Lu}')) AS BIGINT) AS n_capitals, CAST(len(regexp_extract_all(t, '!')) AS BIGINT) AS n_exclamations,
    CAST(len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS BIGINT) AS n_stutter
    FROM w LEFT JOIN cov USING (k)),
b AS (SELECT *, CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT + 8 * (100 * n_dup_lines > 40 * n_lines)::INT
    + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT + 32 * (2 * n_capitals > word_chars)::INT + 64 * (10 * n_exclamations > 3 * n_words)::INT
    + 128 * (100 * n_stutter > 20 * n_words)::INT AS INTEGER) AS failure_bits FROM m)
SELECT *, failure_bits & 3 <> 0 AS base_failed, failure_bits = 0 AS kept FROM b
"""
