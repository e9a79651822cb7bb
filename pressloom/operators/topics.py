"""Topics: assignment scoring, roll-up, evaluation of assessments, category hierarchy."""

from __future__ import annotations

from functools import reduce
from random import Random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.functions.vectors import cosine, dot, mean_vector, norm, unit
from pressloom.operators.joins import lookup
from pressloom.operators.ranking import number_rows
from pressloom.session import materialize

CRITERIA = ["material_impact", "institutional_action", "scope_scale", "new_information"]

# Weights and threshold are parameters of this library.
DEFAULT_WEIGHTS = {"embedding": 0.5, "concept": 0.3, "category": 0.1, "time": 0.1}


def score_topic_assignment(pairs: DataFrame, weights: dict[str, float] | None = None, threshold: float = 0.6,
                           decay_hours: float = 72.0) -> DataFrame:
    """Best topic per story and the decision, with every signal for the audit.

    ``pairs`` holds candidate (story_id, topic_id) rows with embedding_similarity,
    concept_overlap_score, category_match and temporal_distance_hours. The composite is the
    weighted sum, nearness in time falling linearly to zero at ``decay_hours``. Ties go to
    the smaller topic id. ``max_by`` combines on the map side, so a story with very many
    candidates is one row per task.
    """
    w = {**DEFAULT_WEIGHTS, **(weights or {})}
    near = F.greatest(F.lit(0.0), 1.0 - F.col("temporal_distance_hours") / F.lit(float(decay_hours)))
    score = (
        F.coalesce(F.col("embedding_similarity"), F.lit(0.0)) * w["embedding"]
        + F.coalesce(F.col("concept_overlap_score"), F.lit(0.0)) * w["concept"]
        + F.coalesce(F.col("category_match"), F.lit(False)).cast("double") * w["category"]
        + F.coalesce(near, F.lit(0.0)) * w["time"]
    )
    signals = ["topic_id", "embedding_similarity", "concept_overlap_score", "category_match",
               "temporal_distance_hours", "composite_score"]
    scored = pairs.withColumn("composite_score", score)
    best = scored.groupBy("story_id").agg(
        F.min_by(F.struct(*signals), F.struct(-F.col("composite_score"), F.col("topic_id"))).alias("_b")
    ).select("story_id", "_b.*")
    return best.withColumns({
        "composite_threshold": F.lit(float(threshold)),
        "action": F.when(F.col("composite_score") >= threshold, "assigned_existing").otherwise("created_new"),
    })


def hyperplane_codes(vector: Column | str, dim: int, tables: int, bits: int, probes: int, seed: int = 29) -> Column:
    """Array of (table, code): the sides of ``bits`` random hyperplanes on which a vector lies, per table.

    After its own code come, up to ``probes`` of a table, those with one of the bits turned whose hyperplanes are
    nearest to the vector. Hyperplanes are drawn from the seed, so all vectors see the same ones.
    """
    random = Random(seed)
    v = F.col(vector) if isinstance(vector, str) else vector

    def side(b: int) -> Column:
        plane = F.array(*[F.lit(random.choice((-1.0, 1.0))) for _ in range(dim)])
        return F.struct(F.lit(1 << b).alias("bit"), dot(v, plane).alias("distance"))

    def codes(table: int) -> Column:
        sides = F.array(*[side(b) for b in range(bits)])

        def near(found: Column) -> Column:
            own = F.aggregate(found, F.lit(0), lambda code, s: code + F.when(s["distance"] >= 0, s["bit"]).otherwise(0))
            turned = F.slice(F.array_sort(F.transform(found, lambda s: F.struct(F.abs(s["distance"]).alias("distance"), s["bit"].alias("bit")))), 1, probes - 1)
            return F.transform(F.concat(F.array(F.lit(0)), F.transform(turned, lambda s: s["bit"])),
                               lambda bit: F.struct(F.lit(table).alias("table"), own.bitwiseXOR(bit).alias("code")))

        # The distances are computed once, in an array of one element.
        return F.flatten(F.transform(F.array(sides), near))

    return F.concat(*[codes(t) for t in range(tables)])


def candidate_topics(stories: DataFrame, centroids: DataFrame, dim: int, k: int = 3, exact: bool = False, tables: int = 8, bits: int = 6,
                     probes: int = 4, block: int = 256, story: str = "story_id", topic: str = "topic_id", vector: str = "embedding",
                     centroid: str = "centroid", digits: int = 9) -> DataFrame:
    """(story, topic, embedding_similarity): the ``k`` topics nearest to a story, ties (to ``digits`` places) to the smaller id.

    With the index (the default), topics are looked for in the buckets of random hyperplanes that a story's vector
    falls into, and beside them; every topic is in the index, and what is found is compared exactly. With ``exact``, every
    story meets all topics, ``block`` at a time, and a row per story and block leaves with the best of it. Vectors
    without a length have no candidates.
    """
    own = stories.where(norm(vector) > 0).select(story, unit(vector).alias("_v"))
    named = centroids.where(norm(centroid) > 0).select(topic, unit(centroid).alias("_c"))
    similarity = F.round(dot("_v", "_c"), digits)
    if exact:
        numbered = number_rows(named, [], [F.col(topic).asc()], "_n").withColumn("_block", F.floor((F.col("_n") - 1) / block))
        blocks = materialize(numbered.groupBy("_block").agg(F.collect_list(F.struct(F.col(topic), F.col("_c"))).alias("_topics")), "topic-blocks")
        many = blocks.count()
        if not many:
            return own.join(named, F.lit(False)).select(story, topic, similarity.alias("embedding_similarity"))
        spread = own.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(many - 1).cast("bigint"))))
        ranked = F.array_sort(F.transform("_topics", lambda t: F.struct((-F.round(dot(F.col("_v"), t["_c"]), digits)).alias("s"), t[topic].alias("t"))))
        best = spread.join(blocks, "_block").select(story, F.explode(F.slice(ranked, 1, k)).alias("_b"))
        found = best.select(story, F.col("_b.t").alias(topic), (-F.col("_b.s")).alias("embedding_similarity"))
    else:
        buckets = named.select(topic, F.explode(hyperplane_codes("_c", dim, tables, bits, 1)).alias("_at"))
        probed = own.select(story, F.explode(hyperplane_codes("_v", dim, tables, bits, probes)).alias("_at"))
        pairs = probed.join(buckets, "_at").select(story, topic).distinct()
        found = lookup(pairs, named, topic, [story], "inner").join(own, story).select(story, topic, similarity.alias("embedding_similarity"))
    place = F.row_number().over(Window.partitionBy(story).orderBy(F.desc("embedding_similarity"), topic))
    return found.withColumn("_r", place).where(F.col("_r") <= k).drop("_r")


def topic_value_counts(rows: DataFrame, column: str, topic: str = "topic_id") -> DataFrame:
    """(topic, value, n): the long form of a topic's frequency map."""
    return rows.where(F.col(column).isNotNull()).groupBy(topic, F.col(column).alias("value")).agg(
        F.count("*").alias("n")
    )


def count_map(counts: DataFrame, name: str, topic: str = "topic_id") -> DataFrame:
    """Frequency map per topic; built from counted values, one entry per distinct value."""
    entries = F.sort_array(F.collect_list(F.struct("value", "n")))
    return counts.groupBy(topic).agg(F.map_from_entries(entries).alias(name))


def dominant_value(counts: DataFrame, name: str, topic: str = "topic_id") -> DataFrame:
    """Most frequent value per topic, ties to the smaller value."""
    return counts.groupBy(topic).agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias(name))


def topic_centroids(rows: DataFrame, dim: int, topic: str = "topic_id", vector: str = "embedding") -> DataFrame:
    return rows.groupBy(topic).agg(mean_vector(vector, dim).alias("centroid"))


def topic_medoids(rows: DataFrame, centroids: DataFrame, topic: str = "topic_id", story: str = "story_id",
                  vector: str = "embedding", label: str = "headline", digits: int = 9) -> DataFrame:
    """Story nearest to its topic's centroid, ties (to ``digits`` places) to the smaller id."""
    joined = lookup(rows.select(topic, story, vector, label), centroids, topic, [story], "inner")
    similarity = F.round(cosine(vector, "centroid"), digits)
    return joined.groupBy(topic).agg(
        F.min_by(F.struct(F.col(story).alias("medoid_id"), F.col(label).alias("label"), similarity.alias("medoid_similarity")),
                 F.struct(-similarity, F.col(story))).alias("_m")
    ).select(topic, "_m.*")


def topic_rollup(stories: DataFrame, dim: int) -> DataFrame:
    """One row per topic. ``stories`` needs topic_id, story_id, embedding, headline,
    top_category, published_at.

    Categories are a closed set and become a map. The concept and entity frequencies of a
    topic are an open vocabulary; they stay rows (``topic_value_counts``), and ``count_map``
    turns them into a map where the caller knows that it fits one row.
    """
    base = stories.groupBy("topic_id").agg(
        F.count("*").alias("story_count"),
        F.min("published_at").alias("earliest_published_at"),
        F.max("published_at").alias("latest_published_at"),
        mean_vector("embedding", dim).alias("centroid"),
    )
    categories = topic_value_counts(stories, "top_category")
    out = (
        base.join(topic_medoids(stories, base.select("topic_id", "centroid")), "topic_id", "left")
        .join(count_map(categories, "category_counts"), "topic_id", "left")
        .join(dominant_value(categories, "dominant_category"), "topic_id", "left")
    )
    return out


STATE_VALUES = ("top_category", "concept", "entity")


def topic_state(stories: DataFrame, dim: int) -> DataFrame:
    """What a batch of stories adds to its topics, in rows that can be added up: per topic one row of counts, times and
    vector sums (``kind`` is 'topic'), and one per topic and value of each of ``STATE_VALUES`` among the columns.

    Values that are arrays count once per element and story. The vocabulary of a topic is open, so it stays rows.
    """
    v = F.col("embedding")
    base = stories.groupBy("topic_id").agg(
        F.count("*").alias("n"), F.count("embedding").alias("vectors"), F.min("published_at").alias("earliest"), F.max("published_at").alias("latest"),
        F.array(*[F.coalesce(F.sum(F.get(v, F.lit(i)).cast("double")), F.lit(0.0)) for i in range(dim)]).alias("sums"))
    out = base.select("topic_id", F.lit("topic").alias("kind"), F.lit(None).cast("string").alias("value"), "n", "vectors", "earliest", "latest", "sums")
    types = dict(stories.dtypes)
    for column in STATE_VALUES:
        if column not in types:
            continue
        value = F.explode(F.array_distinct(column)) if types[column].startswith("array") else F.col(column)
        counts = stories.select("topic_id", value.alias("value")).where("value IS NOT NULL").groupBy("topic_id", F.col("value").cast("string").alias("value")).agg(F.count("*").alias("n"))
        out = out.unionByName(counts.withColumn("kind", F.lit(column)), allowMissingColumns=True)
    return out


def merge_topic_states(states: DataFrame, dim: int) -> DataFrame:
    """The state of all batches whose states are given, in the same form."""
    sums = F.array(*[F.sum(F.get(F.col("sums"), F.lit(i))) for i in range(dim)])
    return states.groupBy("topic_id", "kind", "value").agg(
        F.sum("n").alias("n"), F.sum("vectors").alias("vectors"), F.min("earliest").alias("earliest"), F.max("latest").alias("latest"), sums.alias("sums"))


def rollup_of_state(state: DataFrame) -> DataFrame:
    """One row per topic: story_count, times, centroid, and the dominant value of each kind."""
    base = state.where("kind = 'topic'").select(
        "topic_id", F.col("n").alias("story_count"), F.col("earliest").alias("earliest_published_at"), F.col("latest").alias("latest_published_at"),
        F.when(F.col("vectors") > 0, F.transform("sums", lambda x: x / F.col("vectors"))).alias("centroid"))
    for column in STATE_VALUES:
        counts = state.where(F.col("kind") == column).select("topic_id", "value", "n")
        base = base.join(dominant_value(counts, f"dominant_{column.removeprefix('top_')}"), "topic_id", "left")
    return base


def met_count(prefix: str = "") -> Column:
    """Number of true criteria, 0 to 4; an unknown criterion counts as not met."""
    ones = [F.coalesce(F.col(f"{prefix}{c}"), F.lit(False)).cast("int") for c in CRITERIA]
    return reduce(lambda a, b: a + b, ones)


def assessment_met_count(assessments: DataFrame) -> DataFrame:
    return assessments.withColumn("met_count", met_count())


def eval_matches(results: DataFrame) -> DataFrame:
    """Per-story agreement of model and human."""
    same = [(F.col(f"llm_{c}") == F.col(f"human_{c}")).cast("int") for c in CRITERIA]
    return results.withColumns({
        "label_match": F.col("llm_label") == F.col("human_label"),
        "pi_match": F.col("llm_is_public_interest") == F.col("human_is_public_interest"),
        "criteria_match_count": reduce(lambda a, b: a + b, same),
    })


def pi_eval_metrics(results: DataFrame, by: list[str]) -> DataFrame:
    """Accuracy, precision, recall, F1, error rates and per-criterion accuracy."""
    said, truth = F.col("llm_is_public_interest"), F.col("human_is_public_interest")
    counts = results.groupBy(*by).agg(
        F.count("*").alias("benchmark_size"),
        F.count_if(said & truth).alias("_tp"), F.count_if(said & ~truth).alias("_fp"),
        F.count_if(~said & truth).alias("_fn"), F.count_if(~said & ~truth).alias("_tn"),
        *[F.avg((F.col(f"llm_{c}") == F.col(f"human_{c}")).cast("int")).alias(f"accuracy_{c}") for c in CRITERIA],
    )
    tp, fp, fn, tn = (F.col(c) for c in ("_tp", "_fp", "_fn", "_tn"))
    return counts.select(
        *by, "benchmark_size",
        F.try_divide(tp + tn, F.col("benchmark_size")).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision_pi"),
        F.try_divide(tp, tp + fn).alias("recall_pi"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1_pi"),
        F.try_divide(fp, fp + tn).alias("false_positive_rate"),
        F.try_divide(fn, fn + tp).alias("false_negative_rate"),
        *[f"accuracy_{c}" for c in CRITERIA],
    )


def category_ancestors(categories: DataFrame) -> DataFrame:
    """(uri, ancestor_uri, depth) along ``parent_uri``, nearest first.

    A parent that is no row of the table is still an ancestor, and ends the walk. Known
    steps are doubled: ancestors of the deepest ancestors found so far are joined on, so a
    chain of any length takes the logarithm of it in rounds. A pair that is known already is
    not taken again, which ends cycles. Rounds are written to the shared folder.
    """
    edges = categories.select("uri", F.col("parent_uri").alias("ancestor_uri")).where("ancestor_uri IS NOT NULL").distinct()
    found = materialize(edges.withColumn("depth", F.lit(1).cast("bigint")), "ancestors")
    reach = 1
    while True:
        deepest = found.where(F.col("depth") == reach).select("uri", F.col("ancestor_uri").alias("_via"))
        onward = found.select(F.col("uri").alias("_via"), F.col("ancestor_uri").alias("_next"), F.col("depth").alias("_more"))
        steps = deepest.join(onward, "_via").groupBy("uri", F.col("_next").alias("ancestor_uri")).agg(
            (F.min("_more") + reach).alias("depth"))
        new = materialize(steps.join(found.select("uri", "ancestor_uri"), ["uri", "ancestor_uri"], "left_anti"), "ancestors")
        if new.isEmpty():
            return found
        found = found.unionByName(new)
        reach *= 2
