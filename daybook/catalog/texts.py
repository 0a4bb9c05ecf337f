"""Rules over text, answers and request batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.catalog.registry import query
from daybook.operators import labels, windows
from daybook.operators.settle import settle
from daybook.session import shared_folder

# Synthetic rules; the last one found in a text decides.
_RULES = (
    ("the ", 1.0), (" le ", 1.5), (" und ", 2.0), ("tion[ ,.]", 2.5), ("[Ll]icense", 3.0),
    ("http", 3.5), ("@", 4.0), ("[0-9][0-9][0-9]-[0-9][0-9]", 4.5), ("password", 5.0), ("sh that", 5.5),
)
_CASES = " ".join(f"WHEN regexp_matches(text, '{p}') THEN {s}" for p, s in reversed(_RULES))


@query(f"SELECT doc_id, CAST(CASE {_CASES} ELSE n_chars % 5 END AS DOUBLE) AS elevated FROM documents")
def ordered_rule_override(t):
    elevated = (F.col("n_chars") % 5).cast("double")
    return t.documents.select("doc_id", labels.ordered_rules(F.col("text"), elevated, _RULES).alias("elevated"))


# Five hundred rules of two neighbouring words of the documents, some with a class or an option, some with an alternative.
@query(r"""WITH w AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z]{3,}') AS w FROM documents),
    two AS (SELECT DISTINCT w[1 + doc_id % 5] AS a, w[2 + doc_id % 5] AS b FROM w WHERE len(w) > 7),
    r AS (SELECT row_number() OVER (ORDER BY a, b) AS ordinal, a, b FROM (SELECT a, b FROM two ORDER BY md5(a || b) LIMIT 500)),
    p AS (SELECT ordinal, CASE ordinal % 4 WHEN 0 THEN a || '[ ,.]+' || b WHEN 1 THEN a || '[.,]' WHEN 2 THEN a || 's? ' || b
        ELSE a || ' ' END AS pattern FROM r UNION ALL VALUES (0, 'q[a-z]x|xy'), (1000, 'zz'))
    SELECT doc_id, coalesce(arg_max(ordinal % 10, ordinal) FILTER (WHERE regexp_matches(text, pattern)), -1)::DOUBLE AS score
    FROM documents, p GROUP BY doc_id""")
def ordered_rule_table(t):
    w = F.col("w")
    found = t.documents.select("doc_id", F.regexp_extract_all("text", F.lit("[A-Za-z]{3,}"), F.lit(0)).alias("w")).where(F.size(w) > 7)
    two = found.select(F.get(w, (F.col("doc_id") % 5).cast("int")).alias("a"), F.get(w, (F.col("doc_id") % 5 + 1).cast("int")).alias("b")).distinct()
    some = two.orderBy(F.md5(F.concat("a", "b"))).limit(500)
    named = some.select("a", "b", F.concat_ws("\x01", "a", "b").alias("name"), F.lit(0.0).alias("v"))
    ranked = windows.numbered(named, "v", "name", "ordinal")
    a, b, nth = F.col("a"), F.col("b"), F.col("ordinal") % 4
    pattern = (F.when(nth == 0, F.concat(a, F.lit("[ ,.]+"), b)).when(nth == 1, F.concat(a, F.lit("[.,]")))
               .when(nth == 2, F.concat(a, F.lit("s? "), b)).otherwise(F.concat(a, F.lit(" "))))
    rules = ranked.select("ordinal", pattern.alias("pattern")).unionByName(
        t.spark.createDataFrame([(0, "q[a-z]x|xy"), (1000, "zz")], "ordinal int, pattern string"))
    rules = settle(rules.withColumn("score", (F.col("ordinal") % 10).cast("double")), "rules", shared_folder(t.spark))
    return labels.rule_scores(t.documents.select("doc_id", "text"), "text", rules, "score", F.lit(-1.0)).select("doc_id", "score")


@query("""WITH k AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
    SELECT event_id, event_type AS exercise_name, 'a, b' AS muscle_groups, k AS match_score FROM k
    WHERE event_type IN ('click', 'purchase', 'signup')
    UNION ALL SELECT event_id, 'second', NULL, k FROM k WHERE event_type = 'purchase'""")
def parse_fenced_json(t):
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    one = F.concat(F.lit('{"exercise_name": "'), kind, F.lit('", "muscle_groups": "a, b", "match_score": '), k, F.lit("}"))
    two = F.concat(one, F.lit(', {"exercise_name": "second", "muscle_groups": null, "match_score": '), k, F.lit("}"))
    fence, close = F.lit("Here it is:\n```json\n["), F.lit("]\n```")
    answer = (
        F.when(kind == "click", F.concat(F.lit(" ["), one, F.lit("]\n")))
        .when(kind == "purchase", F.concat(fence, two, close, F.lit("\n")))
        .when(kind == "signup", F.concat(fence, one, close))
        .when(kind == "view", F.concat(F.lit("["), one, F.lit(", {]")))
        .otherwise(F.concat(fence, one, close, F.lit("\nThat is all.")))
    )
    return labels.parse_answers(t.events.select("event_id", answer.alias("content")), "content", keep=["event_id"])


@query("""WITH n AS (SELECT c_name, row_number() OVER (ORDER BY md5(c_name)) - 1 AS i FROM (SELECT DISTINCT c_name FROM customer))
    SELECT i // 10 AS batch, CAST(count(*) AS INTEGER) AS n_names, string_agg(c_name, ', ' ORDER BY i) AS names,
    'Classify {these}: ' || string_agg(c_name, ', ' ORDER BY i) || '.' AS request FROM n GROUP BY 1""")
def batch_names(t):
    return labels.batch_names(t.customer, "c_name", 10, "Classify {these}: {names}.")
