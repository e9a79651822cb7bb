"""Article pairs by shared concepts, without emitting all pairs of a concept.

Exact reductions keep the work away from ``sum(n_concept ** 2)``:

* Articles with the same concept set are one *set*; a third of all rows being copies of
  one article is one entry in the comparison.
* Order concepts rarest first. The first two concepts that two sets have in common, if
  they share at least ``t``, both lie in the first ``size - t + 2`` concepts of each. Sets
  are joined on the hash of such two-concept combinations, so a concept that nearly all
  articles have joins nothing by itself. Candidates are then verified on the full sets.
* For a top-k answer, the overlap that is needed comes from the best pairs that each list
  offers. A set needs only its k + 1 smallest articles, since by the tie order no later
  article can be in the answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressloom.functions.times import hours
from pressloom.session import materialize


HOT_CONCEPTS = 1000
HOT_ROWS = 100_000


def concept_sets(bridge: DataFrame, article: str = "article_uri", concept: str = "concept_uri",
                 rare_first: bool = True) -> DataFrame:
    """(article, tokens, g): the article's distinct concepts in a global order, and the set's key.

    The array of one article is the article's own concept list. Rarest first puts the ``HOT_CONCEPTS`` most
    frequent concepts last, by their frequency; the order of the others matters little. Equal sets have
    equal keys: the key is 128 bits of the whole set.
    """
    links = bridge.select(article, concept).where(f"{concept} IS NOT NULL")
    if rare_first:
        hot = links.groupBy(concept).agg(F.count("*").alias("_f")).orderBy(F.desc("_f"), concept).limit(HOT_CONCEPTS)
        ranked = links.join(F.broadcast(hot), concept, "left").select(article, F.struct(F.coalesce("_f", F.lit(0)).alias("f"), concept).alias("c"))
        listed = ranked.groupBy(article).agg(F.transform(F.array_sort(F.collect_set("c")), lambda x: x[concept]).alias("tokens"))
    else:
        listed = links.groupBy(article).agg(F.array_sort(F.collect_set(concept)).alias("tokens"))
    return listed.withColumn("g", F.unhex(F.md5(F.concat_ws("\u0001", "tokens"))))


def _distinct_sets(sets: DataFrame) -> DataFrame:
    return sets.groupBy("g").agg(F.first("tokens").alias("tokens"))


def _signatures(t: int) -> Column:
    """Join keys of a set: hashes of the two-concept combinations of its prefix, or of
    single concepts when one shared concept is enough."""
    tokens = F.col("tokens")
    if t < 2:
        return F.transform(tokens, lambda x: F.xxhash64(x))
    prefix = F.slice(tokens, F.lit(1), F.size(tokens) - F.lit(t - 2))
    return F.flatten(F.transform(
        prefix, lambda x, i: F.transform(F.slice(prefix, i + F.lit(2), F.size(prefix)), lambda y: F.xxhash64(x, y))
    ))


def _candidates(sets: DataFrame, t: int, seekers: Column | None = None) -> DataFrame:
    """(g1, g2): all pairs of distinct sets that share at least ``t`` concepts, and some that share fewer.

    With ``seekers`` one of the two has to meet that condition.
    """
    big = sets.where(F.size("tokens") >= t)
    key = F.explode(_signatures(t)).alias("key")
    b = big.select(F.col("g").alias("g2"), key)
    a = (big if seekers is None else big.where(seekers)).select(F.col("g").alias("g1"), key)
    found = a.join(b, "key").where("g1 < g2" if seekers is None else "g1 != g2")
    return found.select(F.least("g1", "g2").alias("g1"), F.greatest("g1", "g2").alias("g2")).distinct()


def _set_pairs(sets: DataFrame, t: int) -> DataFrame:
    """(g1, g2, shared) of distinct sets that share at least ``t`` concepts, each once."""
    one = sets.select(F.col("g").alias("g1"), F.col("tokens").alias("_t1"))
    two = sets.select(F.col("g").alias("g2"), F.col("tokens").alias("_t2"))
    shared = F.size(F.array_intersect("_t1", "_t2")).alias("shared")
    return _candidates(sets, t).join(one, "g1").join(two, "g2").select("g1", "g2", shared).where(F.col("shared") >= t)


def _article_pairs(pairs: DataFrame, members: DataFrame, sets: DataFrame, article: str, t: int) -> DataFrame:
    """Set pairs, and pairs inside a set, to article pairs (article_1 < article_2)."""
    m1, m2 = members.select("g", F.col(article).alias("x")), members.select("g", F.col(article).alias("y"))
    across = (
        pairs.join(m1.withColumnRenamed("g", "g1"), "g1").join(m2.withColumnRenamed("g", "g2"), "g2")
        .select(F.least("x", "y").alias("article_1"), F.greatest("x", "y").alias("article_2"), "shared")
    )
    sizes = sets.where(F.size("tokens") >= t).select("g", F.size("tokens").alias("shared"))
    inside = (
        sizes.join(m1, "g").join(m2, "g").where("x < y")
        .select(F.col("x").alias("article_1"), F.col("y").alias("article_2"), "shared")
    )
    return across.unionByName(inside).select(
        "article_1", "article_2", F.col("shared").cast("bigint").alias("shared_concepts")
    )


def shared_concept_pairs(bridge: DataFrame, min_shared: int, article: str = "article_uri",
                         concept: str = "concept_uri") -> DataFrame:
    """Every pair of articles with at least ``min_shared`` concepts in common.

    The answer itself can be large when many articles are copies of each other.
    """
    sets = materialize(
        concept_sets(bridge, article, concept, rare_first=min_shared > 2).where(F.size("tokens") >= min_shared), "concept-sets"
    )
    distinct = _distinct_sets(sets)
    return _article_pairs(_set_pairs(distinct, min_shared), sets.select("g", article), distinct, article, min_shared)


def shared_concepts(bridge: DataFrame, k: int = 20, min_shared: int = 1, article: str = "article_uri",
                    concept: str = "concept_uri") -> DataFrame:
    """The ``k`` pairs that share most concepts; ties by (article_1, article_2).

    A threshold algorithm over the lists of two-concept combinations, in two passes of fixed form:

    1. Every list offers up to two of its pairs, from aggregates that combine on the map side. The k best
       of these bound the answer: it has no pair worse than the last of them, (t, x, y).
    2. All pairs that share more than t are found through the prefixes for t + 1, and of those that share
       t only the ones whose smaller article is not after x, through the prefixes for t.

    If fewer than k pairs share two concepts, the lists of the first pass held every such pair, and the
    rest of the answer comes from the smallest articles of each concept.
    """
    sets = concept_sets(bridge, article, concept)
    distinct = materialize(_compared_sets(sets, k, article), "distinct-sets")
    copies = distinct.where(F.size("members") > 1).select(F.col("g").alias("g1"), F.col("g").alias("g2"))
    enough = F.col("shared") >= max(min_shared, 2)
    best = _ranked(_described(_offered(distinct).unionByName(copies), distinct).where(enough), k).select("shared", "ahead.x").collect()  # k rows at most
    if len(best) == k:
        t, x = best[-1]
        found = _candidates(distinct, t + 1).unionByName(_candidates(distinct, t, seekers=F.col("first") <= F.lit(x))).distinct()
        return _best_pairs(_described(found.unionByName(copies), distinct), k)
    top = materialize(_best_pairs(_described(_candidates(distinct, 2).unionByName(copies), distinct).where(enough), k), "top-pairs")
    if min_shared > 1 or top.count() == k:
        return top
    order = [F.col("shared_concepts").desc(), F.col("article_1"), F.col("article_2")]
    return top.unionByName(_single_concept_pairs(sets, top, k, article)).orderBy(*order).limit(k)


def _compared_sets(sets: DataFrame, k: int, article: str) -> DataFrame:
    """(g, tokens, members, first): the distinct sets with their k + 1 smallest articles."""
    w = Window.partitionBy("g").orderBy(article)
    few = sets.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1)
    return few.groupBy("g").agg(F.first("tokens").alias("tokens"), F.array_sort(F.collect_list(article)).alias("members")).withColumn("first", F.col("members")[0])


def _offered(distinct: DataFrame) -> DataFrame:
    """(g1, g2): up to two pairs of sets from each list of a two-concept combination that has two sets or more."""
    entry = F.struct(F.size("tokens").alias("n"), "g")
    even = F.xxhash64("g") % 2 == 0
    posted = distinct.where(F.size("tokens") >= 2).select(entry.alias("e"), even.alias("even"), F.explode(_signatures(2)).alias("key"))
    lists = posted.groupBy("key").agg(
        F.min("e").alias("low"), F.max("e").alias("high"), F.max(F.when(F.col("even"), F.col("e"))).alias("a"), F.max(F.when(~F.col("even"), F.col("e"))).alias("b"))
    two = F.explode(F.array(F.struct(F.col("low.g").alias("g1"), F.col("high.g").alias("g2")), F.struct(F.col("a.g").alias("g1"), F.col("b.g").alias("g2"))))
    found = lists.where("low != high").select(two.alias("p")).select("p.*").where("g1 IS NOT NULL AND g2 IS NOT NULL")
    return found.select(F.least("g1", "g2").alias("g1"), F.greatest("g1", "g2").alias("g2")).distinct()


def _described(pairs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(shared, m1, m2) of pairs (g1, g2) of sets; a set paired with itself stands for its copies."""
    one = distinct.select(F.col("g").alias("g1"), F.col("tokens").alias("t1"), F.col("members").alias("m1"))
    two = distinct.select(F.col("g").alias("g2"), F.col("tokens").alias("t2"), F.col("members").alias("m2"))
    second = F.when(F.col("g1") != F.col("g2"), F.col("m2"))
    return pairs.join(one, "g1").join(two, "g2").select(F.size(F.array_intersect("t1", "t2")).alias("shared"), "m1", second.alias("m2"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best pairs of sets, each by the pair of its smallest articles (x, y)."""
    x, y = F.col("m1")[0], F.coalesce(F.get("m2", F.lit(0)), F.get("m1", F.lit(1)))
    ahead = F.struct(F.least(x, y).alias("x"), F.greatest(x, y).alias("y"))
    return found.withColumn("ahead", ahead).orderBy(F.desc("shared"), "ahead").limit(k)


def _best_pairs(found: DataFrame, k: int) -> DataFrame:
    """The k best pairs of articles: shared_concepts, article_1, article_2.

    A pair of sets stands for the pair of its smallest articles first, so the k best pairs of sets are enough.
    """
    both = F.coalesce("m2", "m1")
    listed = F.flatten(F.transform("m1", lambda x: F.transform(F.filter(both, lambda y: F.col("m2").isNotNull() | (y > x)),
                                                              lambda y: F.struct(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")))))
    pairs = _ranked(found, k).select("shared", F.explode(F.slice(F.array_sort(listed), 1, k)).alias("p"))
    return pairs.select(
        F.col("p.x").alias("article_1"), F.col("p.y").alias("article_2"), F.col("shared").cast("bigint").alias("shared_concepts"),
    ).orderBy(F.desc("shared_concepts"), "article_1", "article_2").limit(k)


def _single_concept_pairs(sets: DataFrame, known: DataFrame, k: int, article: str) -> DataFrame:
    """The smallest pairs that share exactly one concept, given all (fewer than k) pairs
    that share more.

    In (article_1, article_2) order the first 2k pairs of a concept involve only its 2k
    smallest articles; fewer than k of them can be known pairs, so at least k remain.
    """
    n = 2 * k
    posted = sets.select(article, F.explode("tokens").alias("token"))
    w = Window.partitionBy("token").orderBy(article)
    small = posted.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n + 1)
    # Pair (i, j) of the sorted members is needed only among the first n pairs in order.
    lists = small.groupBy("token").agg(F.sort_array(F.collect_list(article)).alias("m"))
    rows = F.transform(
        F.col("m"),
        lambda x, i: F.transform(
            F.slice(F.col("m"), i + F.lit(2), F.lit(n)), lambda y: F.struct(x.alias("article_1"), y.alias("article_2"))
        ),
    )
    pairs = lists.select(F.explode(F.slice(F.flatten(rows), 1, n)).alias("p")).select("p.*").distinct()
    return pairs.join(F.broadcast(known), ["article_1", "article_2"], "left_anti").withColumn(
        "shared_concepts", F.lit(1).cast("bigint")
    ).orderBy("article_1", "article_2").limit(k)


def top_entities(links: DataFrame, k: int = 25, concept: str = "concept_uri") -> DataFrame:
    return (
        links.groupBy(concept).agg(F.count("*").alias("article_count"))
        .orderBy(F.desc("article_count"), concept).limit(k)
    )


def stop_concepts(links: DataFrame, max_share: float, article: str = "article_uri",
                  concept: str = "concept_uri") -> DataFrame:
    """Concepts linked to more than ``max_share`` of the articles."""
    total = links.agg(F.count_distinct(article)).scalar()
    counted = links.groupBy(concept).agg(F.count("*").alias("article_count"))
    share = F.col("article_count") / total
    return counted.withColumn("share", share).where(F.col("share") > max_share)


def multi_signal_links(articles: DataFrame, bridge: DataFrame, k: int = 3, max_hours: int = 24,
                       time_gate: str = "both", article: str = "article_uri",
                       concept: str = "concept_uri") -> DataFrame:
    """Links (article_1 earlier than article_2) that connect articles of one story.

    Two articles match when they have the same event, or share at least ``k`` concepts and
    the category, and were published at most ``max_hours`` apart (``time_gate='both'``; with
    ``'concept_branch'`` the event branch is free of it). Articles that match share a key: the event, or
    one of the combinations of ``k`` of their concepts together with the category. Each article is linked to
    the one before it in time under each of its keys, if that is near enough. Every link is a
    match, and articles that match are joined by the chain of their key, since those between them
    are nearer still. So there is at most one link per article and key, however alike the sets are.

    An article has C(n, k) concept keys, n being the number of its own concepts.
    ``articles`` needs article, event_uri, category, ts.
    """
    if time_gate not in ("both", "concept_branch"):
        raise ValueError(f"unknown time_gate {time_gate}")
    dated = articles.where("ts IS NOT NULL").select(article, "event_uri", "category", "ts")
    events = dated.where("event_uri IS NOT NULL AND event_uri <> ''").select(*_key(F.array("event_uri")), "ts", article)
    listed = _concept_keys(bridge, k, article, concept).join(dated.where("category IS NOT NULL"), article)
    keyed = listed.select("ts", article, "category", F.explode("combinations").alias("c")).select(
        *_key(F.array_append("c", F.col("category"))), "ts", article)
    same_event = _chain(events, article, max_hours if time_gate == "both" else None)
    return same_event.unionByName(_chain(keyed, article, max_hours)).distinct()


def multi_signal_clusters(articles: DataFrame, bridge: DataFrame, k: int = 3, max_hours: int = 24,
                          time_gate: str = "both", article: str = "article_uri",
                          concept: str = "concept_uri") -> DataFrame:
    """(article, cluster): the smallest article that links lead to, for every article."""
    links = multi_signal_links(articles, bridge, k, max_hours, time_gate, article, concept)
    labels = propagate_labels(links.select(F.col("article_1").alias("a"), F.col("article_2").alias("b")))
    labels = labels.withColumnRenamed("node", article)
    return articles.select(article).where(F.col(article).isNotNull()).distinct().join(labels, article, "left").select(article, F.coalesce("label", article).alias("cluster"))


def propagate_labels(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of the component, for the nodes of links (a, b).

    Each round a node takes the smallest label among its own and its neighbours', and then the
    label of that node, so that labels travel further with every round; it ends when none changes.
    Minima combine on the map side and no neighbour list is collected.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b")
    both = materialize(both.distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        offered = both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), F.col("label").alias("m"))
        least = offered.unionByName(labels.select("node", F.col("label").alias("m"))).groupBy("node").agg(F.min("m").alias("m"))
        further = labels.select(F.col("node").alias("m"), "label")
        moved = least.join(further, "m").select("node", F.least("m", "label").alias("label"))
        moved = materialize(moved, "labels")
        if moved.join(labels, ["node", "label"], "left_anti").isEmpty():
            return moved
        labels = moved


def _concept_keys(bridge: DataFrame, k: int, article: str, concept: str) -> DataFrame:
    """(article, combinations): all combinations of ``k`` of an article's concepts, each sorted."""
    listed = bridge.where(f"{concept} IS NOT NULL").groupBy(article).agg(F.array_sort(F.collect_set(concept)).alias("tokens"))
    tokens = F.col("tokens")
    found = F.transform(tokens, lambda x, i: F.struct(F.array(x).alias("c"), i.alias("i")))
    for _ in range(k - 1):
        # Each combination grows by every concept after its last one.
        found = F.flatten(F.transform(found, lambda f: F.transform(
            F.slice(tokens, f["i"] + F.lit(2), F.size(tokens)), lambda x, j: F.struct(F.array_append(f["c"], x).alias("c"), (f["i"] + j + F.lit(1)).alias("i")))))
    return listed.where(F.size("tokens") >= k).select(article, found["c"].alias("combinations"))


def _key(parts: Column) -> list[Column]:
    """Two 64-bit hashes that stand for the parts."""
    return [F.xxhash64(parts).alias("key"), F.xxhash64(F.lit(1), parts).alias("more")]


def _chain(rows: DataFrame, article: str, max_hours: int | None) -> DataFrame:
    """Links of each article to the one before it in (ts, article) order under the same key, if that
    is near enough (any is without ``max_hours``).

    Rows are shuffled once, by their key. Keys of more than ``HOT_ROWS`` rows, of which a table has
    few for its size, are found first by counting key hashes and go by hours instead.
    """
    hot = materialize(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT_ROWS).select("key"), "hot-keys")
    seq = F.struct("ts", article)
    if hot.isEmpty():
        linked = _lagged(rows, seq, article)
    else:
        cold = rows.join(F.broadcast(hot), "key", "left_anti")
        linked = _lagged(cold, seq, article).unionByName(_lagged_by_hour(rows.join(F.broadcast(hot), "key", "left_semi"), seq, article))
    near = F.lit(True) if max_hours is None else F.col("ts") <= F.col("_p.ts") + hours(max_hours)
    return linked.where(near).select(F.col(f"_p.{article}").alias("article_1"), F.col(article).alias("article_2"))


def _lagged(rows: DataFrame, seq: Column, article: str) -> DataFrame:
    """(_p, ts, article): each row with the one before it under its key."""
    w = Window.partitionBy("key", "more").orderBy("ts", article)
    return rows.withColumn("_p", F.lag(seq).over(w)).where("_p IS NOT NULL").select("_p", "ts", article)


def _lagged_by_hour(rows: DataFrame, seq: Column, article: str) -> DataFrame:
    """The same, with every key cut into hours: inside an hour a window finds the row before, and
    the first row of an hour follows the last one of the key's previous filled hour."""
    rows = rows.withColumn("h", F.date_trunc("hour", "ts"))
    inner = Window.partitionBy("key", "more", "h").orderBy("ts", article)
    inside = rows.withColumn("_p", F.lag(seq).over(inner)).where("_p IS NOT NULL").select("_p", "ts", article)
    ends = rows.groupBy("key", "more", "h").agg(F.max(seq).alias("_last"), F.min(seq).alias("_first"))
    over_hours = Window.partitionBy("key", "more").orderBy("h")
    borders = ends.withColumn("_p", F.lag("_last").over(over_hours)).where("_p IS NOT NULL").select("_p", "_first.*")
    return inside.unionByName(borders)
