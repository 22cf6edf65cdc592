"""Rule-based document types with request and response tables for an external model.

Rules are compiled to one expression per row, or one pass of an automaton where they are many (see
`keywords`): no join and no shuffle. Model answers come
back as a table and are merged with one join on the document key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.functions import json as J
from foliospark.functions import text as T
from foliospark.functions.binding import bind
from foliospark.functions.money import parse_number
from foliospark.functions.patterns import search, tame_spaces
from foliospark.operators import keywords as KW
from foliospark.rules import Keywords, RuleSet

RESULT_COLUMNS = (
    "predicted_type", "confidence", "method", "reasoning", "key_indicators", "error",
)
INSTRUCTION = (
    "Name the kind of business document the text below is. Answer with one JSON object with the "
    "keys predicted_type, confidence (0 to 1), reasoning and key_indicators (a list).\n\n"
)


def _any_contained(haystack: Column, words: tuple[str, ...]) -> Column:
    test = haystack.contains(words[0])
    for word in words[1:]:
        test = test | haystack.contains(word)
    return test


def filename_type(name_lower: Column, keywords: Keywords) -> Column:
    """First type, in declared order, with a keyword in the file name; NULL when none has."""
    chosen = None
    for doc_type, words in keywords.items():
        hit = _any_contained(name_lower, words)
        chosen = F.when(hit, doc_type) if chosen is None else chosen.when(hit, doc_type)
    return F.lit(None).cast("string") if chosen is None else chosen


def keyword_scores(text_lower: Column, keywords: Keywords) -> dict[str, Column]:
    """Per type, how many of its listed keywords occur in the text."""
    scores = {}
    for doc_type, words in keywords.items():
        hits = [text_lower.contains(w).cast("int") for w in words]
        scores[doc_type] = sum(hits[1:], hits[0])
    return scores


def best_score(scores: dict[str, Column]) -> Column:
    """STRUCT(score, neg_ord, type) of the highest score; the first declared type wins ties."""
    entries = [
        F.struct(s.alias("score"), F.lit(-i).alias("neg_ord"), F.lit(t).alias("type"))
        for i, (t, s) in enumerate(scores.items())
    ]
    return F.array_max(F.array(*entries))


def with_filename_type(df: DataFrame, name_lower: str, keywords: Keywords, out: str) -> DataFrame:
    """Add the type by file name, in the form that suits the number of keywords."""
    if KW.keyword_count(keywords) <= KW.EXPRESSION_KEYWORDS:
        return df.withColumn(out, filename_type(F.col(name_lower), keywords))
    hits = KW.with_hits(df, name_lower, keywords)
    return hits.withColumn(out, KW.first_hit(F.col("_hits"), keywords)).drop("_hits")


def with_best_score(df: DataFrame, text_lower: str, keywords: Keywords, out: str) -> DataFrame:
    """Add the best score of the text, in the form that suits the number of keywords; NULL for a
    NULL text."""
    if not KW.keyword_count(keywords):
        return df.withColumn(out, F.lit(None).cast("struct<score:int,neg_ord:int,type:string>"))
    if KW.keyword_count(keywords) <= KW.EXPRESSION_KEYWORDS:
        best = best_score(keyword_scores(F.col(text_lower), keywords))
        return df.withColumn(out, F.when(F.col(text_lower).isNotNull(), best))
    hits = KW.with_hits(df, text_lower, keywords)
    return hits.withColumn(out, KW.best_hit(F.col("_hits"), keywords)).drop("_hits")


def with_lower(df: DataFrame, text: str = "text", name: str = "file_name") -> DataFrame:
    """Lower-case once; the projections after it use the result many times."""
    return df.withColumns({"_text_lower": F.lower(text), "_name_lower": F.lower(name)})


def content_keyword_scores(
    df: DataFrame, rule_set: RuleSet = rules.FULL_RULES, text: str = "text"
) -> DataFrame:
    """Add one column `score_<type>` per type with content keywords."""
    lowered = df.withColumn("_text_lower", F.lower(text))
    scores = keyword_scores(F.col("_text_lower"), rule_set.content)
    return lowered.withColumns({f"score_{t}": c for t, c in scores.items()}).drop("_text_lower")


def _content_result(best: Column, rule_set: RuleSet) -> tuple[Column, Column, Column]:
    score = best["score"]
    low = F.when(score == 2, rule_set.two_hit_confidence).when(
        score == 1, rule_set.one_hit_confidence
    )
    high = score >= rule_set.high_score
    accepted_low = low >= rule_set.threshold
    return (
        F.when(high | accepted_low, best["type"]),
        F.when(high, rule_set.high_confidence).when(accepted_low, low),
        F.when(high, "rules_content_high").when(accepted_low, "rules_content_low"),
    )


def classify_by_filename(
    df: DataFrame, rule_set: RuleSet = rules.FULL_RULES, name: str = "file_name"
) -> DataFrame:
    """Add predicted_type, confidence and method from the file name alone."""
    lowered = df.withColumn("_name_lower", F.lower(name))
    typed = with_filename_type(lowered, "_name_lower", rule_set.filename, "predicted_type")
    hit = F.col("predicted_type").isNotNull()
    return typed.withColumns(
        {
            "confidence": F.when(hit, rule_set.filename_confidence),
            "method": F.when(hit, "rules_filename"),
        }
    ).drop("_name_lower")


def classify_by_content(
    df: DataFrame, rule_set: RuleSet = rules.FULL_RULES, text: str = "text"
) -> DataFrame:
    """Add predicted_type, confidence and method from the text alone."""
    scored = with_best_score(df.withColumn("_text_lower", F.lower(text)), "_text_lower", rule_set.content, "_best")
    scored = bind(scored.drop("_text_lower"), ["_best"])
    doc_type, confidence, method = _content_result(F.col("_best"), rule_set)
    return scored.withColumns(
        {"predicted_type": doc_type, "confidence": confidence, "method": method}
    ).drop("_best")


def classify_with_rules(
    df: DataFrame,
    rule_set: RuleSet = rules.FULL_RULES,
    text: str = "text",
    name: str = "file_name",
) -> DataFrame:
    """File name first, then content. Adds the result columns and `status`.

    `status` is `resolved`, `unresolved` (no rule applies; result columns are those used when
    no model is asked) or `error` (blank text). The texts of documents that their file name
    or blankness decides are not searched.
    """
    typed = df.withColumns(
        {"_blank": T.is_blank(F.coalesce(F.col(text), F.lit(""))), "_name_lower": F.lower(name)}
    )
    typed = with_filename_type(typed, "_name_lower", rule_set.filename, "_by_name").drop("_name_lower")
    open_ = ~F.col("_blank") & F.col("_by_name").isNull()
    typed = typed.withColumn("_text_lower", F.when(open_, F.lower(text)))
    typed = with_best_score(typed, "_text_lower", rule_set.content, "_best").drop("_text_lower")
    typed = bind(typed, ["_blank", "_by_name", "_best"])
    blank, by_name = F.col("_blank"), F.col("_by_name")
    doc_type, confidence, method = _content_result(F.col("_best"), rule_set)
    named = by_name.isNotNull()
    resolved = named | doc_type.isNotNull()
    return typed.select(
        *df.columns,
        F.when(blank, "error").when(resolved, "resolved").otherwise("unresolved").alias("status"),
        F.when(blank, "ERROR").when(named, by_name)
        .otherwise(F.coalesce(doc_type, F.lit("other"))).alias("predicted_type"),
        F.when(blank, 0.0).when(named, rule_set.filename_confidence)
        .otherwise(F.coalesce(confidence, F.lit(0.0))).alias("confidence"),
        F.when(blank, "rules_error").when(named, "rules_filename")
        .otherwise(F.coalesce(method, F.lit("rules_failed"))).alias("method"),
        F.when(blank, "").when(resolved, rules.REASON_BY_RULES)
        .otherwise(rules.REASON_NO_FALLBACK).alias("reasoning"),
        F.lit("[]").alias("key_indicators"),
        F.when(blank, rules.ERROR_EMPTY_TEXT).otherwise("").alias("error"),
    )


def classification_requests(
    classified: DataFrame,
    limit: tuple[int, float, float] = rules.CLASSIFY_TEXT_LIMIT,
    instruction: str = INSTRUCTION,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """What to ask a model: one row per unresolved document."""
    body = T.truncate_head_tail(F.col(text), limit)
    return classified.where(F.col("status") == "unresolved").select(
        key, F.concat(F.lit(instruction), body).alias("request")
    )


def parse_classification_responses(responses: DataFrame, origin: str = "llm") -> DataFrame:
    """Add the result columns to a table with `response` (and, optionally, `error`).

    No object in the answer, or an object without a type, is a parse error; text in braces
    that is not JSON, an unusable confidence or a failed call is a connection error. `origin`
    names the client in those two types.
    """
    call_error = (
        F.col("error") if "error" in responses.columns else F.lit(None).cast("string")
    )
    read = responses.withColumn(
        "_v", J.parse_object(J.outermost_object(F.col("response")))
    ).withColumns(
        {
            "_call_error": call_error,
            "_type": J.get_string(F.col("_v"), "predicted_type"),
            "_confidence": F.when(
                J.has_key(F.col("_v"), "confidence"),
                parse_number(J.get_string(F.col("_v"), "confidence")),
            ).otherwise(0.5),
        }
    )
    read = bind(read, ["_v", "_call_error", "_type", "_confidence"])
    failure = F.coalesce(
        F.col("_call_error"),
        F.when(F.col("response").isNull(), "no response"),
        F.when(F.col("_v").isNull(), "invalid JSON in response"),
        F.when(F.col("_confidence").isNull(), "invalid confidence in response"),
    )
    failed = failure.isNotNull()
    indicators = F.when(
        J.has_key(F.col("_v"), "key_indicators"), J.get_string(F.col("_v"), "key_indicators")
    )
    kept = [c for c in responses.columns if c != "error"]
    return read.select(
        *kept,
        F.when(failed, f"{origin}_connection_error")
        .otherwise(F.lower(F.coalesce("_type", F.lit(f"{origin}_parse_error"))))
        .alias("predicted_type"),
        F.when(failed, 0.0).otherwise(F.round("_confidence", 4)).alias("confidence"),
        F.lit("llm_generative").alias("method"),
        F.when(failed, "")
        .otherwise(F.coalesce(J.get_string(F.col("_v"), "reasoning"), F.lit("")))
        .alias("reasoning"),
        F.when(failed, "[]").otherwise(F.coalesce(indicators, F.lit("[]"))).alias("key_indicators"),
        F.coalesce(failure, F.lit("")).alias("error"),
    )


def latest_answers(answers: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per `key`: response and error (null where `answers` has none).

    Of several answers the one with the greatest `answered_at` counts; where that is absent or
    equal, one without an error, then the greatest response. Combined before the shuffle.
    """
    has = set(answers.columns)
    error = F.col("error") if "error" in has else F.lit(None).cast("string")
    order = [F.col("answered_at")] if "answered_at" in has else []
    best = F.max(F.struct(*order, error.isNull().alias("ok"), "response", error.alias("error")))
    return answers.groupBy(key).agg(best.alias("_a")).select(
        key, F.col("_a.response").alias("response"), F.col("_a.error").alias("error")
    )


def apply_fallback(
    classified: DataFrame, responses: DataFrame, key: str = "doc_id", origin: str = "llm"
) -> DataFrame:
    """Replace the results of unresolved rows by model answers, the latest one per `key`.

    An unresolved row without an answer becomes a connection error. Both sides have one row
    per document, so the join cannot be skewed.
    """
    answers = latest_answers(responses, key).withColumnRenamed("error", "_answer_error")
    joined = classified.join(answers, key, "left")
    rest = [c for c in classified.columns if c not in RESULT_COLUMNS]
    ruled = F.struct(*RESULT_COLUMNS).alias("_ruled")
    # answers are only parsed where the rules left the row open
    open_ = F.col("status") == "unresolved"
    staged = joined.select(
        *rest, ruled, F.when(open_, F.col("response")).alias("response"),
        F.when(open_, F.col("_answer_error")).alias("error"),
    )
    parsed = parse_classification_responses(staged, origin)
    return parsed.select(
        *rest,
        *(
            F.when(open_, F.col(c)).otherwise(F.col(f"_ruled.{c}")).alias(c)
            for c in RESULT_COLUMNS
        ),
    )


def label_to_type(label: Column) -> Column:
    """Optional: a model's free label in the spelling of the type names (`Bank Statement`)."""
    return F.regexp_replace(F.lower(T.strip(label)), r"[\s-]+", "_")


def classification_metrics(results: DataFrame) -> DataFrame:
    return results.select("document_name", *RESULT_COLUMNS)


def classification_tracker(results: DataFrame) -> DataFrame:
    return results.select("document_name", "predicted_type", "confidence", "method", "reasoning")


def ordered_keyword_class(text: Column) -> Column:
    """Credit notes, remittance advices and purchase orders first, then invoices.

    Without any of the phrases, an invoice number still makes an invoice. That last test sees
    lower-cased text and is case-sensitive, so the number must start with a digit, `-` or `_`.
    """
    lowered = F.lower(text)
    chosen = None
    for doc_type, phrases in rules.ORDERED_TYPE_PHRASES:
        hit = _any_contained(lowered, phrases)
        chosen = F.when(hit, doc_type) if chosen is None else chosen.when(hit, doc_type)
    number = None
    for pattern in rules.INVOICE_NUMBER_PATTERNS:
        hit = search(lowered, tame_spaces(pattern), "(?dU)") != ""
        number = hit if number is None else number | hit
    return chosen.when(number, "invoice").otherwise("unknown")
