"""Bounded copy about a trend: templates, and the checks that a narrative must pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ATTEMPTS = 3
# Templates, vocabularies and patterns of the narrative's contract.
SUMMARY = "Attention to {name} topics {direction_word} in the supplied comparison."
SUDDEN_SUMMARY = "Attention to {name} topics was suddenly trending in the supplied comparison."
INTERPRETATION = "{category_text} brands may find the supplied topic group commercially relevant."
RATIONALE = "The {rating} rating is a qualitative assessment based on the supplied topics' relevance to {category_text}."
BRAND_CATEGORIES = ("Advertising", "Air quality", "Apparel", "Automotive", "Beauty", "Consumer electronics", "Entertainment", "Financial services", "Food and beverage", "Gaming", "Health and wellness", "Home improvement", "Home systems", "HVAC", "Insurance", "Outdoor recreation", "Personal care", "Pet care", "Retail", "Software", "Sports", "Telecommunications", "Travel")
RATINGS = ("high", "medium", "low")
PROHIBITED = {
    "causation": r"\b(caus(?:e|ed|es|ing)|because of|due to|led to|resulted in|driv(?:e|es|en|ing)|prompt(?:s|ed|ing)|trigger(?:s|ed|ing)|explains?|spurr(?:ed|ing|s)|fuel(?:s|ed|ing)|spark(?:s|ed|ing)|attributable to|stems? from|owing to)\b",
    "reader identity": r"\b(readers?|viewers?|users?|homeowners?|shoppers?|buyers?|purchasers?|consumers|fans?|enthusiasts?)\b|\b(?:people|individuals?|households?)\s+(?:are|who|with|seeking|planning)\b|\baudience\s+(?:consists?|comprises?|is|are)\b",
    "income": r"\b(income|salary|wealthy|affluent|high[- ]net[- ]worth|high[- ]earners?|low[- ]earners?|disposable income|earning power|prosperous|well[- ]off|upper[- ]income)\b",
    "intent": r"\b(intend(?:s|ed|ing)?|planning to (?:buy|purchase)|purchase intent|shopping for|ready to (?:buy|purchase)|want(?:s|ed)? to (?:buy|purchase)|seek(?:s|ing)? to (?:buy|purchase|acquire)|aim(?:s|ed|ing)? to (?:buy|purchase|acquire)|looking to (?:buy|purchase)|interested in (?:buying|purchasing))\b",
    "prediction": r"\b(will|forecast(?:s|ed|ing)?|predict(?:s|ed|ion|ing)?|likely to|expected to|set to|poised to|going to|future demand|anticipat(?:e|es|ed|ing)|(?:should|could|may|might) (?:expand|grow|increase|rise|decline|fall|contract))\b",
}
_NUMBER = r"(?:zero|one|two|three|four|five|six|seven|eight|nine|ten|hundred|thousand|million|billion|percent|\d[\d,.]*%?|doubled|tripled|halved|surged|soared|spiked|plummeted|collapsed|record|unprecedented|massive|dramatic|sharp|significant|substantial|slight|modest|high|low)"
_TRAFFIC = r"(?:traffic|views?|pageviews?|visits?|attention)"
INVENTED_TRAFFIC = rf"(?:\b{_TRAFFIC}\b[^.!?]{{0,50}}\b{_NUMBER}\b|\b{_NUMBER}\b[^.!?]{{0,50}}\b{_TRAFFIC}\b)"


def _filled(template: str, **values: Column) -> Column:
    parts, rest = [], template
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        parts += [F.lit(before), values[name]]
    return F.concat(*parts, F.lit(rest))


def summary(name: Column, direction: Column) -> Column:
    word = F.when(direction == "robust_growth", "rose").otherwise("declined")
    return F.when(direction == "sudden_growth", _filled(SUDDEN_SUMMARY, name=name)).otherwise(_filled(SUMMARY, name=name, direction_word=word))


def narrative_templates(items: DataFrame) -> DataFrame:
    """items(name, direction, brand_categories, buying_power_rating, ...) with the texts that their facts allow."""
    categories = F.array_join("brand_categories", ", ")
    return items.withColumns({
        "summary": summary(F.col("name"), F.col("direction")),
        "commercial_interpretation": _filled(INTERPRETATION, category_text=categories),
        "buying_power_rationale": _filled(RATIONALE, rating=F.col("buying_power_rating"), category_text=categories),
    })


NARRATIVE = "struct<name:string,summary:string,commercial_interpretation:string,brand_categories:array<string>,buying_power_rating:string,buying_power_rationale:string>"


def narrative_validation(narratives: DataFrame) -> DataFrame:
    """narratives(source_name, direction, narrative) with errors, sorted by kind of check; an empty list is a valid narrative.

    Errors of form come alone. The source's name is taken out before claims are looked for; digits of all scripts count.
    """
    n = F.col("narrative")
    texts = ("name", "summary", "commercial_interpretation", "buying_power_rationale")
    categories = n["brand_categories"]
    form = F.array_compact(F.array(
        *(F.when(n[t].isNull() | (n[t] == ""), F.lit(f"{t} is missing")) for t in texts),
        F.when(categories.isNull() | (F.size(categories) < 1) | (F.size(categories) > 10) | (F.size(F.array_distinct(categories)) != F.size(categories)), F.lit("brand_categories is out of bounds")),
        F.when(F.size(F.array_except(F.coalesce(categories, F.array().cast("array<string>")), F.array(*map(F.lit, BRAND_CATEGORIES)))) > 0, F.lit("brand_categories has an unlisted value")),
        F.when(~F.coalesce(n["buying_power_rating"].isin(*RATINGS), F.lit(False)), F.lit("buying_power_rating has an unlisted value")),
    ))
    text = F.replace(F.concat_ws(" ", n["name"], n["summary"], n["commercial_interpretation"], F.array_join(categories, " "), n["buying_power_rating"], n["buying_power_rationale"]), F.col("source_name"), F.lit(""))
    found = lambda pattern: F.rlike(text, F.lit("(?iuU)" + pattern))
    claims = [F.when(found(p), F.lit(f"prohibited {k} claim")) for k, p in PROHIBITED.items()]
    category_text = F.array_join(categories, ", ")
    outside = lambda field, allowed: F.when(~allowed, F.lit(f"{field} is outside the bounded narrative template"))
    growing = F.when(F.col("direction") == "robust_growth", "growing").when(F.col("direction") == "robust_shrinking", "shrinking")
    looser = _filled(SUMMARY, name=F.col("source_name"), direction_word=growing)
    fine_summary = (n["summary"] == summary(F.col("source_name"), F.col("direction"))) | F.coalesce(n["summary"] == looser, F.lit(False))
    bounded = [
        outside("summary", fine_summary), outside("name", n["name"] == F.col("source_name")),
        outside("commercial_interpretation", n["commercial_interpretation"] == _filled(INTERPRETATION, category_text=category_text)),
        outside("buying_power_rationale", n["buying_power_rationale"] == _filled(RATIONALE, rating=n["buying_power_rating"], category_text=category_text)),
    ]
    content = F.array_compact(F.array(*claims, F.when(found(INVENTED_TRAFFIC), F.lit("prohibited invented traffic claim")), *bounded))
    return narratives.withColumn("errors", F.when(F.size(form) > 0, F.array_sort(form)).otherwise(content))


def first_valid(attempts: DataFrame, most: int = ATTEMPTS) -> DataFrame:
    """attempts(cluster_id, attempt, source_name, direction, narrative) -> the first valid narrative of each cluster within the allowed attempts."""
    good = narrative_validation(attempts).where((F.size("errors") == 0) & (F.col("attempt") <= most))
    order = Window.partitionBy("cluster_id").orderBy("attempt")
    return good.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("cluster_id", "attempt", "narrative")


RECORD = f"cluster_id string, attempt int, delivery_status string, validation_status string, errors array<string>, narrative {NARRATIVE}"


def attempt_records(given: DataFrame, most: int = ATTEMPTS) -> DataFrame:
    """given(cluster_id, attempt, source_name, direction, output, delivery_error) -> what is kept of each attempt, up to the first valid one.

    output is JSON. An attempt that did not arrive is not validated; one that arrived has the errors that validation finds.
    """
    arrived = F.col("delivery_error").isNull()
    checked = narrative_validation(given.where(F.col("attempt") <= most).withColumn("narrative", F.from_json("output", NARRATIVE)))
    status = F.when(~arrived, "not_run").when(F.size("errors") == 0, "valid").otherwise("invalid")
    kept = checked.select("cluster_id", F.col("attempt").cast("int").alias("attempt"), F.when(arrived, "delivered").otherwise("error").alias("delivery_status"), status.alias("validation_status"), F.when(arrived, F.col("errors")).otherwise(F.array("delivery_error")).alias("errors"), F.when(arrived, F.col("narrative")).alias("narrative"))
    before = Window.partitionBy("cluster_id").orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)
    return kept.withColumn("over", F.coalesce(F.max(F.col("validation_status") == "valid").over(before), F.lit(False))).where("NOT over").drop("over")


def attempt_faults(attempts: DataFrame, facts: DataFrame, published: DataFrame, most: int = ATTEMPTS) -> DataFrame:
    """(cluster_id, fault) of the attempts (RECORD) that do not lead to what is published (cluster_id, narrative), given facts(cluster_id, source_name, direction).

    Attempts are numbered from 1 without gaps; every delivered one is validated again against the facts, whatever its
    record says; the last one alone is valid, and it is what is published.
    """
    joined = attempts.withColumnRenamed("errors", "told").join(facts.select("cluster_id", "source_name", "direction"), "cluster_id", "left")
    again = narrative_validation(joined)
    delivered = (F.col("delivery_status") == "delivered") & (F.col("validation_status") == F.when(F.size("errors") == 0, "valid").otherwise("invalid")) & F.col("told").eqNullSafe(F.col("errors"))
    lost = (F.col("delivery_status") == "error") & (F.col("validation_status") == "not_run") & F.col("narrative").isNull() & (F.size("told") > 0)
    judged = again.withColumn("fine", F.coalesce(delivered | lost, F.lit(False))).withColumn("valid", F.coalesce(F.col("validation_status") == "valid", F.lit(False)))
    whole = judged.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("attempt").alias("first"), F.max("attempt").alias("last"), F.countDistinct("attempt").alias("different"), F.count_if(~F.col("fine")).alias("wrong"), F.count_if("valid").alias("valid"),
        F.max_by("valid", "attempt").alias("ends_valid"), F.max_by("narrative", "attempt").alias("narrative"),
    )
    shown = published.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("shown"), F.first("narrative").alias("out"))
    known = facts.select("cluster_id", F.lit(True).alias("known"))
    fault = (
        F.when(F.col("known").isNull(), "unknown cluster").when(F.col("n").isNull(), "no attempts").when(~F.coalesce(F.col("shown") == 1, F.lit(False)), "not published once")
        .when(~F.coalesce((F.col("first") == 1) & (F.col("last") == F.col("n")) & (F.col("different") == F.col("n")) & (F.col("n") <= most), F.lit(False)), "attempts are not numbered")
        .when(F.col("wrong") > 0, "an attempt is not what validation finds").when((F.col("valid") != 1) | ~F.col("ends_valid"), "not the last attempt alone is valid")
        .when(~F.col("narrative").eqNullSafe(F.col("out")), "another narrative is published")
    )
    return known.join(whole, "cluster_id", "full").join(shown, "cluster_id", "full").select("cluster_id", fault.alias("fault")).where("fault IS NOT NULL")
