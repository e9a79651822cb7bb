"""Media coverage: who covers what, how much, when first, and what is left out.

Counts are grouped by the extracted label, and dimensions are joined after counting, so
a source or concept with a third of all rows is one row in every join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.functions.jsonx import items, label_at, parsed, text_at
from pressloom.functions.text import is_populated
from pressloom.operators.joins import lookup
from pressloom.operators.ranking import number_rows
from pressloom.session import materialize


def source_title(column: str = "source") -> Column:
    return text_at(F.parse_json(F.nullif(F.col(column), F.lit(""))), "title")


def concept_coverage_by_source(articles: DataFrame, label: str) -> DataFrame:
    """Mentions of one concept (by its English label) per source title."""
    hits = articles.select(source_title().alias("source_title"), F.explode(items(parsed("concepts"))).alias("_e"))
    return hits.where(label_at(F.col("_e")) == label).groupBy("source_title").agg(F.count("*").alias("articles"))


def articles_for_concept(articles: DataFrame, links: DataFrame, concepts: DataFrame | None = None,
                         uri: str | None = None, label: str | None = None) -> DataFrame:
    """Articles linked to a concept given by uri, or by the English label of its row."""
    if uri is not None:
        hit = links.where(F.col("concept_uri") == uri)
    else:
        named = concepts.where(text_at(F.parse_json("label"), "eng") == label).select(F.col("uri").alias("concept_uri"))
        hit = links.join(named, "concept_uri", "left_semi")
    return articles.join(hit.select(F.col("article_uri").alias("uri")).distinct(), "uri", "left_semi")


def flag_public_interest_concepts(articles: DataFrame, links: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Articles with a flag whether they are linked to a watched concept. The watch list is
    curated; Spark broadcasts it while it is under the threshold."""
    hit = links.join(watchlist.select("concept_uri").distinct(), "concept_uri", "left_semi")
    flagged = hit.select(F.col("article_uri").alias("uri")).distinct().withColumn("_w", F.lit(True))
    return articles.join(flagged, "uri", "left").withColumn(
        "public_interest_concept", F.coalesce(F.col("_w"), F.lit(False))
    ).drop("_w")


def top_entities_by_label(articles: DataFrame, k: int = 25) -> DataFrame:
    exploded = articles.select(F.explode(items(parsed("concepts"))).alias("_e"))
    return (
        exploded.groupBy(label_at(F.col("_e")).alias("concept")).agg(F.count("*").alias("article_count"))
        .orderBy(F.desc("article_count"), F.asc_nulls_last("concept")).limit(k)
    )


def category_distribution(articles: DataFrame) -> DataFrame:
    """Articles per category uri."""
    exploded = articles.select(F.explode(items(parsed("categories"))).alias("_e"))
    return exploded.groupBy(text_at(F.col("_e"), "uri").alias("category")).agg(F.count("*").alias("articles"))


def concept_category_pairs(articles: DataFrame) -> DataFrame:
    """(uri, concept, category) for each concept with each category of the same article.
    Both lists come from the article's own row, so nothing is shuffled."""
    one = articles.select("uri", "categories", F.explode(items(parsed("concepts"))).alias("_c"))
    two = one.select("uri", "_c", F.explode(items(parsed("categories"))).alias("_g"))
    return two.select("uri", label_at(F.col("_c")).alias("concept"), text_at(F.col("_g"), "uri").alias("category"))


def concept_category_matrix(articles: DataFrame, k: int = 50) -> DataFrame:
    return (
        concept_category_pairs(articles).groupBy("concept", "category").agg(F.count("*").alias("article_count"))
        .orderBy(F.desc("article_count"), F.asc_nulls_last("concept"), F.asc_nulls_last("category")).limit(k)
    )


def location_distribution(articles: DataFrame, k: int = 20) -> DataFrame:
    rows = articles.where(is_populated("location")).select(label_at(F.parse_json("location")).alias("location"))
    return (
        rows.groupBy("location").agg(F.count("*").alias("articles"))
        .orderBy(F.desc("articles"), F.asc_nulls_last("location")).limit(k)
    )


def source_specialization(articles: DataFrame, k: int = 50) -> DataFrame:
    exploded = articles.select(
        source_title().alias("source_title"), F.explode(items(parsed("categories"))).alias("_e")
    )
    return (
        exploded.groupBy("source_title", text_at(F.col("_e"), "uri").alias("category"))
        .agg(F.count("*").alias("articles"))
        .orderBy(F.desc("articles"), F.asc_nulls_last("source_title"), F.asc_nulls_last("category")).limit(k)
    )


def event_outlet_counts(articles: DataFrame) -> DataFrame:
    """Articles per event and source uri, the cells of the coverage heat map."""
    return articles.groupBy("event_uri", "source_uri").agg(F.count("*").alias("coverage"))


def event_source_coverage(articles: DataFrame) -> DataFrame:
    return articles.groupBy("event_uri", source_title().alias("source_title")).agg(F.count("*").alias("articles"))


def narrative_propagation(articles: DataFrame, event: str | None = None) -> DataFrame:
    """First publication per source, in time order; without an event, for all events with
    the rank of the source inside the event. The rank runs over sources, not articles."""
    rows = articles if event is None else articles.where(F.col("event_uri") == event)
    rows = rows.where("event_uri IS NOT NULL AND event_uri <> ''")
    first = rows.groupBy("event_uri", source_title().alias("source_title")).agg(
        F.min("date_time_published").alias("first_article")
    )
    if event is not None:
        return first.drop("event_uri").orderBy(F.asc_nulls_last("first_article"), "source_title")
    w = Window.partitionBy("event_uri").orderBy(F.asc_nulls_last("first_article"))
    return first.withColumn("arrival", F.rank().over(w).cast("bigint"))


WORD_BITS = 64


def coverage_omissions(articles: DataFrame, outlets: DataFrame, event: str = "event_uri", source: str = "source_uri") -> DataFrame:
    """Outlet and event with no article of the one on the other.

    Outlets are numbered; the numbers that cover an event are bits of 64-bit words, put together by an
    aggregate that combines on the map side. The gaps are the bits that the words of an event lack, and only
    they become rows. An event that no listed outlet covers has no words and all outlets as gaps.
    """
    listed = outlets.select(source).where(F.col(source).isNotNull()).distinct()
    numbered = materialize(number_rows(listed, [], [F.col(source).asc()], "_n").select(source, (F.col("_n") - 1).alias("_n")), "outlets")
    count = numbered.count()
    if not count:
        return articles.where(F.lit(False)).select(event, source)
    filled = articles.where(F.col(event).isNotNull() & (F.col(event) != "")).select(event, source)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_n") % WORD_BITS).cast("int"))
    words = lookup(filled, numbered, source, [event]).groupBy(event, F.floor(F.col("_n") / WORD_BITS).alias("_w")).agg(F.bit_or(bit).alias("_bits"))
    covered = words.groupBy(event).agg(F.map_from_entries(F.collect_list(F.when(F.col("_w").isNotNull(), F.struct("_w", "_bits")))).alias("_words"))

    def gaps(w: Column) -> Column:
        bits = F.coalesce(F.try_element_at("_words", w), F.lit(0).cast("bigint"))
        free = F.filter(F.sequence(F.lit(0), F.lit(WORD_BITS - 1)), lambda b: (F.getbit(bits, b) == 0) & (w * WORD_BITS + b < count))
        return F.transform(free, lambda b: w * WORD_BITS + b)

    every = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit((count - 1) // WORD_BITS).cast("bigint")), gaps)
    return covered.select(event, F.explode(F.flatten(every)).alias("_n")).join(numbered, "_n").select(event, source)


def top_sources(articles: DataFrame, sources: DataFrame, k: int = 25) -> DataFrame:
    """Articles per source with its title (NULL for an unknown source)."""
    counted = articles.groupBy("source_uri").agg(F.count("*").alias("articles"))
    titles = sources.select(F.col("uri").alias("source_uri"), "title")
    return (
        counted.join(titles, "source_uri", "left").select("title", "source_uri", "articles")
        .orderBy(F.desc("articles"), F.asc_nulls_last("source_uri")).limit(k)
    )


def recent_for_concept(articles: DataFrame, links: DataFrame, concept: str, k: int = 50) -> DataFrame:
    """Latest articles of a concept; undated ones come first, as DESC does by default."""
    hit = links.where(F.col("concept_uri") == concept).select(F.col("article_uri").alias("uri"))
    return (
        articles.join(hit, "uri", "inner").select("uri", "title", "date_time_published")
        .orderBy(F.desc_nulls_first("date_time_published"), "uri").limit(k)
    )


def top_categories(links: DataFrame, categories: DataFrame, k: int = 25) -> DataFrame:
    counted = links.groupBy("category_uri").agg(F.count("*").alias("article_count"))
    named = categories.select(F.col("uri").alias("category_uri"), "label")
    return (
        counted.join(named, "category_uri", "inner")
        .select(F.col("category_uri").alias("uri"), "label", "article_count")
        .orderBy(F.desc("article_count"), "uri").limit(k)
    )


def stories_with_assessment(articles: DataFrame, validation: DataFrame, assessments: DataFrame,
                            scope: DataFrame, k: int = 25) -> DataFrame:
    interesting = assessments.where("is_public_interest").select(
        F.col("story_id").alias("uri"), F.col("label").alias("pi_label"), "met_count"
    )
    return (
        articles.select("uri", "title", "date_time_published")
        .join(validation.select(F.col("story_id").alias("uri"), "top_category"), "uri", "inner")
        .join(interesting, "uri", "inner")
        .join(scope.select(F.col("story_id").alias("uri"), "scope_status"), "uri", "left")
        .orderBy(F.desc_nulls_first("date_time_published"), "uri").limit(k)
        .select("title", "top_category", "pi_label", "met_count", "scope_status")
    )


def enriched_headlines(articles: DataFrame, sources: DataFrame, validation: DataFrame, assignments: DataFrame,
                       topics: DataFrame, assessments: DataFrame, scope: DataFrame, enriched_at,
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """Denormalised story rows. Story tables join on the story id (one row each); topic and
    source rows come by left joins that adaptive execution splits for hot keys. ``keep`` names
    further columns of the join that stay (``source_uri``)."""
    from pressloom.functions.times import instant

    def story(df: DataFrame, *cols) -> DataFrame:
        return df.select(F.col("story_id"), *cols)

    base = articles.select(
        F.col("uri").alias("story_id"), "title", F.col("body").alias("content"), "url", "source_uri",
        F.col("date_time_published").alias("published_at"), F.col("ingestion_source").alias("source_feed"),
    )
    pi = [c for c in ("is_public_interest", "met_count", "material_impact", "institutional_action",
                      "scope_scale", "new_information")]
    return (
        base.join(story(validation, F.col("snippet_clean").alias("description"), "headline_clean", "body_valid",
                        "top_category"), "story_id", "left")
        .join(story(assignments, "topic_id", "composite_score"), "story_id", "left")
        .join(story(assessments, F.col("label").alias("pi_label"), *pi), "story_id", "left")
        .join(story(scope, "scope_status"), "story_id", "left")
        .join(topics.select("topic_id", F.col("label").alias("topic_label"),
                            F.col("story_count").alias("cluster_size"), "dominant_category"), "topic_id", "left")
        .join(sources.select(F.col("uri").alias("source_uri"), F.col("title").alias("source_name")),
              "source_uri", "left")
        .withColumn("enriched_at", instant(enriched_at))
        .select("story_id", "title", "description", "content", "url", "source_name", "published_at",
                "headline_clean", "body_valid", "top_category", "topic_id", "topic_label", "cluster_size",
                "composite_score", "dominant_category", *pi[:1], "pi_label", *pi[1:], "scope_status",
                "source_feed", "enriched_at", *keep)
    )


def in_scope(enriched: DataFrame) -> DataFrame:
    return enriched.where(F.col("scope_status") == "IN_SCOPE")


def topic_coverage_by_bias(enriched: DataFrame, bias: DataFrame, k: int = 50) -> DataFrame:
    per_source = in_scope(enriched).groupBy("topic_label", "source_name").agg(F.count("*").alias("_n"))
    return (
        per_source.join(bias.select("source_name", "composite_bias_label"), "source_name", "inner")
        .groupBy("topic_label", "composite_bias_label").agg(F.sum("_n").alias("article_count"))
        .orderBy(F.desc("article_count"), F.asc_nulls_last("topic_label"), F.asc_nulls_last("composite_bias_label"))
        .limit(k)
    )


def heatmap_cells(enriched: DataFrame, bias: DataFrame | None = None) -> DataFrame:
    """Topic x outlet cells of the stories in scope.

    ``noise`` are stories in scope that are not of public interest; the ratio is NULL when
    there is no noise. With ``bias`` the cells carry the outlet's rating.
    """
    pi = F.coalesce(F.col("is_public_interest"), F.lit(False))
    cells = in_scope(enriched).groupBy("topic_label", "source_name").agg(
        F.count("*").alias("article_count"),
        F.count_if(pi).alias("pi_count"),
        F.count_if(~pi).alias("noise_count"),
        F.max("cluster_size").alias("cluster_size"),
    )
    ratio = F.try_divide(F.col("pi_count"), F.col("noise_count"))
    cells = cells.withColumn("news_to_noise_ratio", ratio)
    if bias is not None:
        cells = cells.join(bias.select("source_name", "adfontes_bias_score"), "source_name", "left")
    return cells


MOST_OUTLETS = 2000


def outlets_by_bias(outlets: DataFrame, score: str = "adfontes_bias_score", source: str = "source_name") -> list[str]:
    """Names of all outlets from left to right, unrated ones last, then by name: the columns of the wide heat map.

    More than ``MOST_OUTLETS`` of them are no table's columns, which is an error: give the outlets that are
    to be shown, ``heatmap_cells`` has all of them as rows.
    """
    found = outlets.where(F.col(source).isNotNull()).groupBy(source).agg(F.min(score).alias("_s")).orderBy(F.asc_nulls_last("_s"), source).limit(MOST_OUTLETS + 1).collect()
    if len(found) > MOST_OUTLETS:
        raise ValueError(f"more than {MOST_OUTLETS} outlets")
    return [r[source] for r in found]


def heatmap_wide(cells: DataFrame, outlets: list[str], value: str = "article_count") -> DataFrame:
    """One row per topic, one column per outlet in the given (left to right) order, zeros
    for gaps, largest topics first."""
    return (
        cells.groupBy("topic_label", "cluster_size").pivot("source_name", outlets).agg(F.first(value))
        .na.fill(0, outlets).orderBy(F.desc_nulls_last("cluster_size"), "topic_label")
    )


def heatmap_asymmetry(enriched: DataFrame, bias: DataFrame) -> DataFrame:
    """Per topic: (left - right) / (left + right) without center outlets, and
    (US - non-US) / (US + non-US)."""
    per_source = in_scope(enriched).groupBy("topic_label", "source_name").agg(F.count("*").alias("_n"))
    joined = per_source.join(bias.select("source_name", "political_group", "geo_group"), "source_name", "inner")

    def total(column: str, value: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(column) == value, F.col("_n"))), F.lit(0))

    sums = joined.groupBy("topic_label").agg(
        total("political_group", "Left").alias("_l"), total("political_group", "Right").alias("_r"),
        total("geo_group", "US").alias("_u"), total("geo_group", "Non-US").alias("_x"),
    )
    return sums.select(
        "topic_label",
        F.try_divide(F.col("_l") - F.col("_r"), F.col("_l") + F.col("_r")).alias("political_skew"),
        F.try_divide(F.col("_u") - F.col("_x"), F.col("_u") + F.col("_x")).alias("geo_skew"),
    )


def composite_bias(scores: DataFrame, lean: float = 1.0, strong: float = 3.0) -> DataFrame:
    """Mean of the available ratings on the +-6 scale, with a five-way label and a group.

    The scales are +-6, +-42 and +-10. The label cut-offs are parameters of this library.
    """
    rescaled = F.array_compact(F.array(
        F.col("allsides_bias_score"),
        F.col("adfontes_bias_score") / F.lit(7.0),
        F.col("mbfc_bias_score") * F.lit(0.6),
    ))
    total = F.aggregate(rescaled, F.lit(0.0), lambda acc, x: acc + x)
    s = F.col("composite_bias_score")
    label = (
        F.when(s.isNull(), F.lit(None)).when(s <= -strong, "Left").when(s <= -lean, "Lean Left")
        .when(s < lean, "Center").when(s < strong, "Lean Right").otherwise("Right")
    )
    group = F.when(s.isNull(), F.lit(None)).when(s <= -lean, "Left").when(s < lean, "Center").otherwise("Right")
    return (
        scores.withColumn("composite_bias_score", F.try_divide(total, F.size(rescaled)))
        .withColumn("composite_bias_label", label).withColumn("political_group", group)
    )


def dockets_by_comments(dockets: DataFrame, counts: DataFrame, k: int = 25) -> DataFrame:
    """Received and posted comment counts per docket. (type, id) is unique, so one
    conditional aggregate replaces two joins to the same table."""
    wide = counts.where(F.col("entity_type").isin("docket_received", "docket_posted")).groupBy(
        F.col("entity_id").alias("docket_id")
    ).agg(
        F.max(F.when(F.col("entity_type") == "docket_received", F.col("comment_count"))).alias("received"),
        F.max(F.when(F.col("entity_type") == "docket_posted", F.col("comment_count"))).alias("posted"),
    )
    return (
        dockets.select("docket_id", "agency_id", "title").join(wide, "docket_id", "left")
        .orderBy(F.desc_nulls_last("received"), "docket_id").limit(k)
    )


def open_documents_by_agency(documents: DataFrame) -> DataFrame:
    return documents.where("open_for_comment").groupBy("agency_id").agg(F.count("*").alias("open_documents"))


def recent_collection_runs(runs: DataFrame, k: int = 10, tie: str = "run_id") -> DataFrame:
    return runs.orderBy(F.desc_nulls_first("started_at"), tie).limit(k)


def articles_per_run(articles: DataFrame) -> DataFrame:
    return articles.groupBy("run_id", "run_type", "nth_run").agg(F.count("*").alias("articles"))


def backfill_progress(runs: DataFrame) -> DataFrame:
    cols = ["run_id", "status", "articles_fetched", "articles_deduped", "rows_loaded", "db_rows_inserted",
            "db_rows_updated"]
    return runs.where("run_type = 'backfill'").select(*cols)


def volume_by_source_day(articles: DataFrame) -> DataFrame:
    """Articles per source, and their mean per day from the first to the last day."""
    day = F.to_date("date_time_published")
    days = F.date_diff(F.max(day), F.min(day)) + 1
    return articles.groupBy("source_uri").agg(
        F.count("*").alias("articles"),
        F.try_divide(F.count(day), days).alias("per_day"),
    )


def concept_facets_by_window(articles: DataFrame, links: DataFrame, width: str = "1 day") -> DataFrame:
    """Concept counts per time window of publication."""
    dated = articles.where("date_time_published IS NOT NULL").select(
        F.col("uri").alias("article_uri"), F.window("date_time_published", width)["start"].alias("window_start")
    )
    return links.join(dated, "article_uri").groupBy("window_start", "concept_uri").agg(F.count("*").alias("articles"))


def concept_facets_by_run(articles: DataFrame, links: DataFrame) -> DataFrame:
    keyed = articles.select(F.col("uri").alias("article_uri"), "run_id", "run_type", "nth_run")
    return links.join(keyed, "article_uri").groupBy("run_id", "run_type", "nth_run", "concept_uri").agg(
        F.count("*").alias("articles")
    )


def category_features(links: DataFrame, roots: list[str]) -> DataFrame:
    """Per article, the number of its categories under each taxonomy root."""
    root = F.split("category_uri", "/")[0]
    return links.groupBy("article_uri").agg(*[F.count_if(root == r).alias(f"n_{r}") for r in roots])


def dedup_summary(validation: DataFrame) -> DataFrame:
    """Kept and duplicate stories, the latter by rule name."""
    from pressloom.functions.text import clean_list

    rules = F.when(F.col("dedup_status") == "duplicate", clean_list("dedup_reason"))
    exploded = validation.select("dedup_status", F.explode_outer(rules).alias("rule"))
    return exploded.groupBy("dedup_status", "rule").agg(F.count("*").alias("stories"))


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    """Anomalies by category, severity and status, severities in their order."""
    from pressloom.contracts import ANOMALY_SEVERITIES

    rank = F.array_position(F.array(*[F.lit(s) for s in ANOMALY_SEVERITIES]), F.col("severity"))
    return anomalies.groupBy("category", "severity", "resolution_status").agg(
        F.count("*").alias("anomalies")
    ).withColumn("severity_rank", rank)


def anomalies_by_item(anomalies: DataFrame, column: str) -> DataFrame:
    """Anomalies per element of an array column (outlets or tags)."""
    return anomalies.select(F.explode(column).alias("item")).groupBy("item").agg(F.count("*").alias("anomalies"))


def enrichment_funnel(runs: DataFrame) -> DataFrame:
    """Share of stories that each enrichment step passes on, per run."""
    steps = ["selected", "validated", "clustered", "judged", "scoped"]
    rates = [
        F.try_divide(F.col(f"stories_{b}"), F.col(f"stories_{a}")).alias(f"{b}_rate")
        for a, b in zip(steps, steps[1:])
    ]
    overall = F.try_divide(F.col("stories_scoped"), F.col("stories_selected")).alias("overall_rate")
    return runs.select("run_id", *[f"stories_{s}" for s in steps], *rates, overall)
