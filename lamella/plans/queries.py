"""Queries of the core operators and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions import codes, flags, hashing, ids, paths, scan, taxa
from lamella.functions.digests import sha256_hex, stripped
from lamella.operators import checks, curation, graph, labels, ranking, reviews, splitting, summaries
from lamella.plans.records import RECORDS_SQL, records, sha_sql
from lamella.sources import boxes, lines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# Equivalence and curation


@query("""
    WITH d AS (SELECT doc_id, sha256(text) AS content FROM documents WHERE text IS NOT NULL),
    c AS (SELECT content, min(doc_id) AS canonical_id FROM d GROUP BY content)
    SELECT d.doc_id, c.canonical_id,
           CASE WHEN d.doc_id = c.canonical_id THEN 'included' ELSE 'excluded_redundant' END AS selection_status
    FROM d JOIN c USING (content)""")
def exact_dedup(spark, folder):
    d = table(spark, folder, "documents").filter("text is not null").select("doc_id", F.sha2("text", 256).alias("content"))
    c = d.groupBy("content").agg(F.min("doc_id").alias("canonical_id"))
    return d.join(c, "content").select(
        "doc_id", "canonical_id", F.when(F.col("doc_id") == F.col("canonical_id"), "included").otherwise("excluded_redundant").alias("selection_status")
    )


@query("""
    WITH d AS (SELECT doc_id, sha256(text) AS content, lang, doc_kind FROM documents WHERE text IS NOT NULL)
    SELECT min(doc_id) AS canonical_id, count(*) AS members,
           count(DISTINCT lang) > 1 OR count(DISTINCT doc_kind) > 1 AS conflict
    FROM d GROUP BY content HAVING count(*) > 1""")
def dedup_clusters(spark, folder):
    d = table(spark, folder, "documents").filter("text is not null").select("doc_id", F.sha2("text", 256).alias("content"), "lang", "doc_kind")
    differ = lambda c: F.coalesce(F.min(c) != F.max(c), F.lit(False))
    return (
        d.groupBy("content").agg(F.min("doc_id").alias("canonical_id"), F.count("*").alias("members"), (differ("lang") | differ("doc_kind")).alias("conflict"))
        .filter("members > 1").select("canonical_id", "members", "conflict")
    )


CURATED_SQL = f"""
    WITH {RECORDS_SQL},
    k AS (SELECT *, CASE WHEN frame_count = 1 THEN 'l:' || lossless_transform_sha256 ELSE 'b:' || sha256 END AS g FROM rec),
    c AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY relative_path, record_no::VARCHAR) AS pos FROM k WHERE g IS NOT NULL),
    f AS (SELECT g, record_no AS c_no, sha256 AS c_sha, pixel_sha256 AS c_pixel FROM c WHERE pos = 1),
    cur AS (SELECT k.record_no, coalesce(f.c_no, k.record_no) AS canonical_no,
        CASE WHEN f.c_no <> k.record_no THEN 'excluded_redundant' ELSE 'included' END AS selection_status,
        CASE WHEN f.c_no <> k.record_no THEN CASE WHEN k.sha256 = f.c_sha THEN 'exact_file_duplicate'
            WHEN k.pixel_sha256 = f.c_pixel THEN 'exact_pixel_duplicate' ELSE 'lossless_transform_duplicate' END END AS exclusion_reason
        FROM k LEFT JOIN f ON k.g = f.g)"""


@query(CURATED_SQL + " SELECT record_no, canonical_no, selection_status, exclusion_reason FROM cur")
def curated_records(spark, folder):
    c = curation.curate(records(table(spark, folder, "images")))
    return c.select("record_no", F.col("canonical_image_id").cast("bigint").alias("canonical_no"), "selection_status", "exclusion_reason")


@query(CURATED_SQL + " SELECT exclusion_reason, count(*) AS n FROM cur WHERE exclusion_reason IS NOT NULL GROUP BY 1")
def dedup_reason_counts(spark, folder):
    c = curation.curate(records(table(spark, folder, "images")))
    return c.filter("exclusion_reason is not null").groupBy("exclusion_reason").agg(F.count("*").alias("n"))


@query(f"""
    WITH {RECORDS_SQL},
    k AS (SELECT CASE WHEN frame_count = 1 THEN 'l:' || lossless_transform_sha256 ELSE 'b:' || sha256 END AS g, candidate_groups FROM rec)
    SELECT g AS group_key, count(*) AS members, count(DISTINCT candidate_groups) > 1 AS conflict FROM k WHERE g IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def label_conflicts(spark, folder):
    return curation.clusters(records(table(spark, folder, "images"))).filter("members > 1").select("group_key", "members", "conflict")


@query(f"""
    WITH {RECORDS_SQL}
    SELECT sha256, count(*) AS n, min(record_no) AS first_member FROM rec WHERE sha256 IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def hash_duplicate_groups(spark, folder):
    return curation.hash_groups(records(table(spark, folder, "images")), "sha256", "record_no")


@query("SELECT doc_id, least(sha256(text), sha256(array_to_string(list_reverse(string_split(text, ' ')), ' ')), sha256(lower(text))) AS invariant FROM documents WHERE text IS NOT NULL")
def invariant_hash(spark, folder):
    t = F.col("text")
    return table(spark, folder, "documents").filter("text is not null").select("doc_id", F.least(F.sha2(t, 256), F.sha2(F.array_join(F.reverse(F.split(t, " ")), " "), 256), F.sha2(F.lower(t), 256)).alias("invariant"))


@query("""
    SELECT vec_id, lower(lpad(to_hex(list_sum(list_transform(range(1, 64),
        lambda i: CASE WHEN embedding[i] > embedding[i + 1] THEN (1::HUGEINT << (63 - i)::INT) ELSE 0::HUGEINT END))::UBIGINT), 16, '0')) AS dhash
    FROM embeddings""")
def dhash_bits(spark, folder):
    e = table(spark, folder, "embeddings")
    return e.select("vec_id", hashing.hex64(hashing.falling_bits([F.col("embedding")[i] for i in range(64)])).alias("dhash"))


NEAR_SQL = f"""
    WITH {RECORDS_SQL},
    i AS MATERIALIZED (SELECT record_no, dhash FROM rec WHERE bit_count(dhash) BETWEEN 4 AND 60),
    p AS (SELECT a.record_no AS key_a, b.record_no AS key_b, bit_count(xor(a.dhash, b.dhash))::BIGINT AS distance
          FROM i a JOIN i b ON a.record_no < b.record_no AND bit_count(xor(a.dhash, b.dhash)) <= 2)"""


@query(NEAR_SQL + " SELECT key_a, key_b, distance FROM p")
def near_dup_pairs(spark, folder):
    return curation.near_pairs(records(table(spark, folder, "images")), "record_no", "dhash")


@query(NEAR_SQL + """, w AS (SELECT key_a AS record_no FROM p UNION SELECT key_b FROM p)
    SELECT r.record_no, w.record_no IS NOT NULL AS near FROM rec r LEFT JOIN w USING (record_no)""")
def near_dup_flagged(spark, folder):
    r = records(table(spark, folder, "images"))
    flagged = curation.flag_near(r, curation.near_pairs(r, "record_no", "dhash"), "record_no")
    return flagged.select("record_no", F.array_contains("import_flags", "near_duplicate_candidate").alias("near"))


# Groups of related records


TOKENS_SQL = f"""
    WITH RECURSIVE img AS (SELECT record_no, image_id, source_id, {sha_sql('sha256')} AS s0, {sha_sql('pixel_sha256')} AS p0, lossless_transform_sha256 AS l, frame_count,
        relationship_keys, lineage, selection_status, canonical_image_id FROM images),
    t AS (
        SELECT image_id AS node, 'file' || chr(1) || s0 AS token, selection_status FROM img WHERE s0 IS NOT NULL
        UNION SELECT image_id, 'pixels' || chr(1) || p0, selection_status FROM img WHERE frame_count = 1 AND p0 IS NOT NULL
        UNION SELECT image_id, 'lossless' || chr(1) || l, selection_status FROM img WHERE frame_count = 1 AND l <> ''
        UNION SELECT image_id, 'relationship' || chr(1) || unnest(list_filter(relationship_keys, lambda x: x <> '')), selection_status FROM img
        UNION SELECT image_id, CASE WHEN e.key = 'source_parent_id' THEN e.key || chr(1) || source_id || chr(1) || e.value ELSE 'lineage' || chr(1) || e.key || chr(1) || e.value END, selection_status
            FROM (SELECT image_id, source_id, selection_status, unnest(map_entries(lineage)) AS e FROM img) WHERE e.value <> '' AND e.key <> 'parent_image_id'
        UNION SELECT image_id, 'id' || chr(1) || image_id, selection_status FROM img
        UNION SELECT image_id, 'id' || chr(1) || lineage['parent_image_id'], selection_status FROM img WHERE lineage['parent_image_id'] <> ''
        UNION SELECT image_id, 'id' || chr(1) || canonical_image_id, selection_status FROM img WHERE canonical_image_id <> '')"""


def _split_records(spark, folder):
    i = table(spark, folder, "images")
    return i.select(
        "image_id", "source_id", sha256_hex(F.col("sha256")).alias("sha256"), sha256_hex(F.col("pixel_sha256")).alias("pixel_sha256"), "lossless_transform_sha256",
        "frame_count", "relationship_keys", "lineage", "selection_status", "canonical_image_id",
    )


def _closure(tokens: str) -> str:
    """Labels by the smallest node reachable, propagated as sets (small inputs only)."""
    return f"""
    , e AS MATERIALIZED (SELECT DISTINCT h.hub AS u, t.node AS v FROM {tokens} t JOIN (SELECT token, min(node) AS hub FROM {tokens} GROUP BY 1) h USING (token) WHERE h.hub <> t.node),
    b AS MATERIALIZED (SELECT u, v FROM e UNION SELECT v, u FROM e),
    reach AS (SELECT node AS a, node AS z FROM (SELECT DISTINCT node FROM {tokens}) UNION SELECT reach.a, b.v FROM reach JOIN b ON reach.z = b.u),
    lab AS (SELECT a AS node, min(z) AS root FROM reach GROUP BY 1)"""


@query(TOKENS_SQL + _closure("t") + " SELECT node AS image_id, root FROM lab")
def components(spark, folder):
    return graph.observed_groups(_split_records(spark, folder))


@query(TOKENS_SQL + ", kept AS (SELECT DISTINCT node, token FROM t WHERE selection_status = 'included')" + _closure("t")
       + ", e2 AS MATERIALIZED (SELECT DISTINCT h.hub AS u, t.node AS v FROM kept t JOIN (SELECT token, min(node) AS hub FROM kept GROUP BY 1) h USING (token) WHERE h.hub <> t.node),"
       + " b2 AS MATERIALIZED (SELECT u, v FROM e2 UNION SELECT v, u FROM e2),"
       + " reach2 AS (SELECT node AS a, node AS z FROM (SELECT DISTINCT node FROM kept) UNION SELECT reach2.a, b2.v FROM reach2 JOIN b2 ON reach2.z = b2.u),"
       + " lab2 AS (SELECT a AS node, min(z) AS root FROM reach2 GROUP BY 1)"
       + " SELECT (SELECT count(DISTINCT root) FROM lab JOIN (SELECT DISTINCT node FROM kept) k USING (node)) AS with_bridges, (SELECT count(DISTINCT root) FROM lab2) AS without_bridges")
def bridge_components(spark, folder):
    r = _split_records(spark, folder)
    kept = r.filter("selection_status = 'included'")
    every = graph.observed_groups(r).join(kept.select("image_id").distinct(), "image_id", "left_semi").agg(F.count_distinct("root").alias("with_bridges"))
    return every.crossJoin(graph.observed_groups(kept).agg(F.count_distinct("root").alias("without_bridges")))


@query(f"""
    WITH RECURSIVE img AS (SELECT image_id, source_id, {sha_sql('sha256')} AS s0, {sha_sql('pixel_sha256')} AS p0, lossless_transform_sha256 AS l, frame_count, relationship_keys, lineage FROM images),
    t AS (SELECT source_id AS node, 'file' || s0 AS token FROM img WHERE s0 IS NOT NULL
        UNION SELECT source_id, 'pixels' || p0 FROM img WHERE frame_count = 1 AND p0 IS NOT NULL
        UNION SELECT source_id, 'lossless' || l FROM img WHERE frame_count = 1 AND l <> ''
        UNION SELECT source_id, 'image' || image_id FROM img UNION SELECT source_id, 'image' || lineage['parent_image_id'] FROM img WHERE lineage['parent_image_id'] <> ''
        UNION SELECT source_id, 'key' || unnest(list_filter(relationship_keys, lambda x: x <> '')) FROM img
        UNION SELECT source_id, e.key || e.value FROM (SELECT source_id, unnest(map_entries(lineage)) AS e FROM img)
            WHERE e.value <> '' AND e.key IN ('tree_id', 'case_id', 'specimen_id', 'slide_id', 'video_id', 'isolate_id')
        ){_closure('t')}
    SELECT node AS source_id, root FROM lab""")
def source_level_components(spark, folder):
    r = _split_records(spark, folder)
    tokens = graph.catalog_tokens(r).distinct()
    return graph.components(r.select(F.col("source_id").alias("node")), graph.star_edges(tokens)).select(F.col("node").alias("source_id"), "root")


@query("SELECT 'eg-' || substr(sha256(to_json(list_sort(list(DISTINCT image_id)))), 1, 16) AS group_id, count(DISTINCT image_id) AS images FROM split_manifest WHERE leakage_group_id IS NOT NULL GROUP BY leakage_group_id")
def component_ids(spark, folder):
    m = table(spark, folder, "split_manifest").filter("leakage_group_id is not null")
    return m.groupBy("leakage_group_id").agg(ids.member_list_id("eg-", F.col("image_id")).alias("group_id"), F.count_distinct("image_id").alias("images")).drop("leakage_group_id")


@query("""
    WITH m AS (SELECT DISTINCT leakage_group_id, image_id FROM split_manifest WHERE leakage_group_id IS NOT NULL)
    SELECT 'eg-' || substr(sha256(count(*)::VARCHAR || '|' || sum(('0x' || substr(sha256(image_id), 1, 12))::BIGINT)::VARCHAR || '|' || min(image_id)), 1, 16) AS group_id, count(*) AS images
    FROM m GROUP BY leakage_group_id""")
def component_digests(spark, folder):
    m = table(spark, folder, "split_manifest").filter("leakage_group_id is not null").select("leakage_group_id", "image_id").distinct()
    return m.groupBy("leakage_group_id").agg(ids.group_digest("eg-", F.col("image_id")).alias("group_id"), F.count("*").alias("images")).drop("leakage_group_id")


@query("""
    SELECT leakage_group_id, count(*) AS images, min(image_id) AS first_image, max(image_id) AS last_image,
           array_to_string(list_sort(list(DISTINCT source_id)), '|') AS sources, array_to_string(list_sort(list_distinct(flatten(list(candidate_groups)))), '|') AS candidate_groups
    FROM images WHERE leakage_group_id IS NOT NULL GROUP BY 1""")
def component_inventory(spark, folder):
    g = splitting.group_inventory(table(spark, folder, "images").filter("leakage_group_id is not null"), "leakage_group_id")
    return g.withColumn("sources", F.array_join("sources", "|")).withColumn("candidate_groups", F.array_join("candidate_groups", "|"))


# Labels


@query("""
    WITH t AS (SELECT image_id, list(DISTINCT row(taxon_group, genus, species)) AS ids,
            count(DISTINCT taxon_group) AS ng, count(*) FILTER (taxon_group IS NULL) AS zg, min(taxon_group) AS g,
            count(DISTINCT genus) AS nn, count(*) FILTER (genus IS NULL) AS zn, min(genus) AS n,
            count(DISTINCT species) AS ns, count(*) FILTER (species IS NULL) AS zs, min(species) AS s FROM taxon_labels GROUP BY 1),
    c AS (SELECT *, CASE WHEN ng = 1 AND zg = 0 THEN g END AS cg FROM t),
    d AS (SELECT *, CASE WHEN cg IS NOT NULL AND nn = 1 AND zn = 0 THEN n END AS cn FROM c)
    SELECT image_id, cg AS taxon_group, cn AS genus, CASE WHEN cn IS NOT NULL AND ns = 1 AND zs = 0 THEN s END AS species,
        CASE WHEN len(ids) > 1 THEN 'multiple_taxa' WHEN cg IS NULL THEN 'unresolved' WHEN cn IS NOT NULL THEN 'single_taxon' ELSE 'group_only' END AS status FROM d""")
def taxon_consensus(spark, folder):
    # The distinct triples of an image, not its rows: a label typed a million times is one taxon.
    triples = table(spark, folder, "taxon_labels").groupBy("image_id").agg(F.collect_set(F.struct(*taxa.RANKS)).alias("taxa"))
    return triples.select("image_id", taxa.consensus(F.col("taxa"), F.lit(None).cast("string")).alias("c")).select("image_id", "c.*")


@query("""
    SELECT label_id, CASE WHEN source_id = 'tgfc' AND source_label IN ('Colletotrichum siamense', 'Olivea tectonae', 'Neopestalotiopsis sp.', 'MixedClass') THEN 'fungi'
        WHEN source_id = 'soil' AND source_label IN ('Fusarium', 'Trichoderma', 'Verticillium') THEN 'fungi'
        WHEN source_id = 'soil' AND source_label IN ('Phytophtora', 'Phytophthora') THEN 'oomycetes'
        WHEN source_id = 'idphy' AND regexp_matches(source_label, '^Phytophthora(\\s|$)') THEN 'oomycetes' ELSE taxon_group END AS taxon_group,
        CASE WHEN source_id = 'idphy' AND regexp_matches(source_label, '^Phytophthora(\\s|$)') THEN 'genus' WHEN taxon_group IS NOT NULL THEN 'group' ELSE 'unresolved' END AS "rank"
    FROM taxon_labels WHERE source_label IS NOT NULL""")
def label_taxa(spark, folder):
    t = table(spark, folder, "taxon_labels").filter("source_label is not null")
    return t.select("label_id", taxa.taxon(F.col("source_id"), F.col("source_label"), F.col("taxon_group")).alias("t")).select("label_id", "t.taxon_group", "t.rank")


@query("""
    SELECT 'group' AS "rank", g AS label, i AS id, NULL AS parent FROM (VALUES ('fungi', 0), ('oomycetes', 1)) v(g, i)
    UNION ALL SELECT 'genus', genus, row_number() OVER (ORDER BY genus) - 1, min(taxon_group) FROM taxon_reference WHERE genus IS NOT NULL GROUP BY genus
    UNION ALL SELECT 'species', species, row_number() OVER (ORDER BY species) - 1, min(genus) FROM taxon_reference WHERE species IS NOT NULL GROUP BY species""")
def label_map(spark, folder):
    return labels.label_map(table(spark, folder, "taxon_reference"))


@query("SELECT 'genus' AS \"rank\", genus AS label, count(DISTINCT taxon_group) AS parents FROM taxon_labels WHERE genus IS NOT NULL AND taxon_group IS NOT NULL GROUP BY 2 HAVING count(DISTINCT taxon_group) > 1 UNION ALL SELECT 'species', species, count(DISTINCT genus) FROM taxon_labels WHERE species IS NOT NULL AND genus IS NOT NULL GROUP BY 2 HAVING count(DISTINCT genus) > 1")
def parent_fd_violations(spark, folder):
    return labels.parent_conflicts(labels.rank_names(table(spark, folder, "taxon_labels")))


MANIFEST_SQL = """
    m AS (SELECT assignment_no, image_id, leakage_group_id AS grp, lower(trim(split)) AS split, source_id,
        taxonomy.taxon_group AS taxon_group, taxonomy.genus AS genus, taxonomy.species AS species FROM split_manifest
        WHERE leakage_group_id IS NOT NULL AND lower(trim(split)) IN ('train', 'validation', 'test')),
    lm AS (SELECT 'genus' AS "rank", genus AS label, row_number() OVER (ORDER BY genus) - 1 AS id FROM taxon_reference WHERE genus IS NOT NULL GROUP BY genus
        UNION ALL SELECT 'species', species, row_number() OVER (ORDER BY species) - 1 FROM taxon_reference WHERE species IS NOT NULL GROUP BY species)"""
FEATURES_SQL = """
    f AS (SELECT assignment_no, grp, split, unnest(['group', 'genus', 'species', 'source']) AS "rank", unnest([taxon_group, genus, species, source_id]) AS label FROM m),
    fx AS (SELECT * FROM f WHERE label IS NOT NULL)"""
SUPPORT_SQL = f"""
    WITH {MANIFEST_SQL}, {FEATURES_SQL},
    s0 AS (SELECT "rank", label, count(*) AS images, count(DISTINCT grp) AS observed_groups,
        count(*) FILTER (split = 'train') AS train_images, count(*) FILTER (split = 'validation') AS validation_images, count(*) FILTER (split = 'test') AS test_images,
        count(DISTINCT grp) FILTER (split = 'train') AS train_groups, count(DISTINCT grp) FILTER (split = 'validation') AS validation_groups, count(DISTINCT grp) FILTER (split = 'test') AS test_groups
        FROM fx GROUP BY 1, 2),
    s AS (SELECT *, train_images > 0 AS training_supported, "rank" NOT IN ('genus', 'species') OR (observed_groups >= 3 AND train_images > 0 AND validation_images > 0 AND test_images > 0) AS evaluation_supported FROM s0)"""


def _manifest(spark, folder):
    m = table(spark, folder, "split_manifest").filter("leakage_group_id is not null")
    return m.select(
        "assignment_no", "image_id", F.col("leakage_group_id").alias("grp"), F.lower(F.trim("split")).alias("split"), "source_id", "taxonomy.taxon_group", "taxonomy.genus", "taxonomy.species"
    ).filter(F.col("split").isin(*labels.SPLITS))


@query(f"""
    WITH {MANIFEST_SQL}
    SELECT m.assignment_no, CASE taxon_group WHEN 'fungi' THEN 0 WHEN 'oomycetes' THEN 1 ELSE -1 END::BIGINT AS group_target, coalesce(g.id, -1) AS genus_target, coalesce(s.id, -1) AS species_target,
        coalesce(taxon_group IN ('fungi', 'oomycetes'), false) AS group_mask, g.id IS NOT NULL AS genus_mask, s.id IS NOT NULL AS species_mask
    FROM m LEFT JOIN lm g ON g."rank" = 'genus' AND g.label = m.genus LEFT JOIN lm s ON s."rank" = 'species' AND s.label = m.species""")
def rank_targets(spark, folder):
    return labels.rank_targets(_manifest(spark, folder), labels.label_map(table(spark, folder, "taxon_reference")), "assignment_no")


@query(f"WITH {MANIFEST_SQL}, {FEATURES_SQL} SELECT \"rank\", label, count(*) AS n FROM (SELECT * FROM f WHERE \"rank\" <> 'source') GROUP BY 1, 2")
def rank_value_counts(spark, folder):
    return summaries.rank_values(_manifest(spark, folder))


@query(f"WITH {MANIFEST_SQL}, {FEATURES_SQL} SELECT \"rank\", label, count(*) AS images, count(DISTINCT grp) AS groups FROM fx GROUP BY 1, 2")
def feature_support(spark, folder):
    return labels.feature_support(_manifest(spark, folder), "grp")


@query(SUPPORT_SQL + """ SELECT "rank", label, images, observed_groups, train_images, validation_images, test_images, train_groups, validation_groups, test_groups, training_supported, evaluation_supported FROM s""")
def label_support(spark, folder):
    return labels.label_support(_manifest(spark, folder), "grp", "split").drop("reasons")


@query(SUPPORT_SQL + """, r AS (SELECT "rank", label, list_filter([CASE WHEN "rank" IN ('genus', 'species') AND observed_groups < 3 THEN 'fewer_than_three_observed_groups' END,
        CASE WHEN "rank" IN ('genus', 'species') AND train_images = 0 THEN 'no_training_examples' END,
        CASE WHEN "rank" IN ('genus', 'species') AND least(train_images, validation_images, test_images) = 0 THEN 'incomplete_threeway_coverage' END], lambda x: x IS NOT NULL) AS rs FROM s)
    SELECT reason, count(*) AS n FROM (SELECT unnest(rs) AS reason FROM r) GROUP BY 1""")
def mask_reasons(spark, folder):
    return reviews.histogram(labels.label_support(_manifest(spark, folder), "grp", "split"), "reasons")


@query(SUPPORT_SQL + """ SELECT "rank", count(*) AS labels, count(*) FILTER (training_supported) AS trained, count(*) FILTER (evaluation_supported) AS evaluable,
        count(*) FILTER ("rank" IN ('genus', 'species') AND training_supported AND NOT evaluation_supported) AS train_only, count(*) FILTER (NOT training_supported) AS untrained FROM s GROUP BY 1""")
def rank_coverage(spark, folder):
    return labels.rank_coverage(labels.label_support(_manifest(spark, folder), "grp", "split"))


@query(SUPPORT_SQL + """
    SELECT m.assignment_no, CASE taxon_group WHEN 'fungi' THEN 0 WHEN 'oomycetes' THEN 1 ELSE -1 END::BIGINT AS group_target, coalesce(g.id, -1) AS genus_target, coalesce(p.id, -1) AS species_target,
        coalesce(taxon_group IN ('fungi', 'oomycetes'), false) AS group_mask,
        g.id IS NOT NULL AND (m.split = 'train' OR coalesce(sg.evaluation_supported, false)) AS genus_mask,
        p.id IS NOT NULL AND (m.split = 'train' OR coalesce(sp.evaluation_supported, false)) AS species_mask
    FROM m LEFT JOIN lm g ON g."rank" = 'genus' AND g.label = m.genus LEFT JOIN lm p ON p."rank" = 'species' AND p.label = m.species
    LEFT JOIN s sg ON sg."rank" = 'genus' AND sg.label = m.genus LEFT JOIN s sp ON sp."rank" = 'species' AND sp.label = m.species""")
def masked_targets(spark, folder):
    m = _manifest(spark, folder)
    t = labels.rank_targets(m, labels.label_map(table(spark, folder, "taxon_reference")), "assignment_no")
    return labels.masked_targets(m, t, labels.label_support(m, "grp", "split"), "assignment_no", "split")


# Splits


@query(f"WITH {MANIFEST_SQL} SELECT split, count(*) AS images, count(DISTINCT grp) AS groups FROM m GROUP BY 1")
def split_counts(spark, folder):
    return splitting.split_counts(_manifest(spark, folder), "grp", "split")


@query(f"WITH {MANIFEST_SQL} SELECT grp, count(DISTINCT split) AS partitions FROM m GROUP BY 1 HAVING count(DISTINCT split) > 1")
def cross_partition_groups(spark, folder):
    return splitting.torn_groups(_manifest(spark, folder), "grp", "split")


@query()
def grouped_split(spark, folder):
    return splitting.assign_groups(_manifest(spark, folder), "grp")


@query(f"WITH {MANIFEST_SQL} SELECT count(DISTINCT grp) AS groups, 0 AS repeated, 3 AS partitions, 6 AS broad_labels FROM m")
def grouped_split_check(spark, folder):
    """What any assignment must hold: every group once, three partitions, both broad labels in each."""
    m = _manifest(spark, folder)
    assigned = splitting.assign_groups(m, "grp")
    once = assigned.agg(F.count_distinct("grp").alias("groups"), (F.count("*") - F.count_distinct("grp")).alias("repeated"), F.count_distinct("split").alias("partitions"))
    broad = m.filter(F.col("taxon_group").isin(*splitting.BROAD)).drop("split").join(assigned, "grp").agg(F.count_distinct("split", "taxon_group").alias("broad_labels"))
    return once.crossJoin(broad)


CROSSING = ("tree_id", "case_id", "specimen_id", "slide_id", "video_id", "isolate_id", "parent_image_id")


@query(f"""
    WITH {MANIFEST_SQL}, img AS (SELECT image_id, source_id, {sha_sql('sha256')} AS s0, {sha_sql('pixel_sha256')} AS p0, lossless_transform_sha256 AS l, relationship_keys, lineage, canonical_image_id FROM images),
    t AS (SELECT image_id, 'file' || chr(1) || s0 AS token FROM img UNION SELECT image_id, 'pixels' || chr(1) || p0 FROM img UNION SELECT image_id, 'lossless' || chr(1) || l FROM img WHERE l <> ''
        UNION SELECT image_id, 'canonical' || chr(1) || image_id FROM img UNION SELECT image_id, 'canonical' || chr(1) || canonical_image_id FROM img WHERE canonical_image_id <> ''
        UNION SELECT image_id, 'parent_image_id' || chr(1) || image_id FROM img
        UNION SELECT image_id, 'relationship' || chr(1) || unnest(list_filter(relationship_keys, lambda x: x <> '')) FROM img
        UNION SELECT image_id, e.key || chr(1) || CASE WHEN e.key = 'source_parent_id' THEN source_id || chr(1) ELSE '' END || e.value
            FROM (SELECT image_id, source_id, unnest(map_entries(lineage)) AS e FROM img) WHERE e.value <> '' AND e.key IN {(*CROSSING, 'source_parent_id')})
    SELECT token, min(split) || '|' || max(split) AS partitions FROM t JOIN (SELECT DISTINCT image_id, split FROM m WHERE split IS NOT NULL) USING (image_id)
    WHERE token IS NOT NULL GROUP BY 1 HAVING min(split) <> max(split)""")
def crossing_relations(spark, folder):
    """The guard of readers: every hash, id, key and lineage value that links images of different partitions."""
    placed = _manifest(spark, folder).filter("split is not null").select(F.col("image_id").alias("node"), "split").distinct()
    tokens = graph.release_tokens(_split_records(spark, folder).withColumn("leakage_group_id", F.col("image_id")), with_source=False)
    return graph.crossing_tokens(tokens, placed).withColumn("partitions", F.array_join("partitions", "|"))


@query("""
    WITH r AS (SELECT leakage_group_id AS group_id, image_id, lower(trim(split)) AS split FROM split_manifest WHERE leakage_group_id IS NOT NULL), g AS (SELECT DISTINCT group_id, split FROM r),
    m AS (SELECT group_id, image_id, bool_or(coalesce(split IN ('train', 'validation', 'test'), false)) AS eligible FROM r GROUP BY 1, 2),
    l AS (SELECT group_id, count(*) FILTER (eligible) AS chosen FROM m GROUP BY 1)
    SELECT group_id, 'split' AS code FROM g JOIN l USING (group_id) WHERE NOT CASE WHEN chosen > 0 THEN coalesce(split IN ('train', 'validation', 'test'), false) ELSE split IS NULL END
    UNION ALL SELECT group_id, 'group_id' FROM g WHERE length(group_id) = 0
    UNION ALL SELECT min(group_id), 'repeated_member' FROM m GROUP BY image_id HAVING count(*) > 1
    UNION ALL SELECT group_id, 'repeated_group' FROM g GROUP BY 1 HAVING count(*) > 1""")
def inventory_checks(spark, folder):
    rows = table(spark, folder, "split_manifest").filter("leakage_group_id is not null").select(F.col("leakage_group_id").alias("group_id"), "image_id", F.lower(F.trim("split")).alias("split"))
    members = rows.groupBy("group_id", "image_id").agg(F.bool_or(F.coalesce(F.col("split").isin(*labels.SPLITS), F.lit(False))).alias("eligible"))
    return splitting.inventory_violations(rows.select("group_id", "split").distinct(), members)


@query("""
    WITH p(source_id, license, attribution, expected, role) AS (VALUES ('tgfc', 'CC BY 4.0', 'authors', 100, NULL), ('idphy', 'CC0', 'gallery', 621, 'full_field'), ('soil', ' ', 'authors', 20, NULL)),
    e AS (SELECT DISTINCT image_id FROM split_manifest UNION SELECT 'no such image'), i AS (SELECT i.*, license, attribution, role FROM images i LEFT JOIN p USING (source_id) WHERE image_id IN (SELECT image_id FROM e)),
    v AS (SELECT image_id, unnest([CASE WHEN NOT coalesce(selection_status = 'included', false) THEN 'excluded' END, CASE WHEN NOT coalesce(frame_count = 1, false) THEN 'frame_count' END,
        CASE WHEN NOT coalesce(len(candidate_groups) = 1 AND candidate_groups[1] IN ('fungi', 'oomycetes'), false) THEN 'candidate_groups' END,
        CASE WHEN coalesce(list_contains(import_flags, 'duplicate_label_conflict'), false) THEN 'duplicate_label_conflict' END,
        CASE WHEN NOT coalesce(length(trim(license)) > 0 AND length(trim(attribution)) > 0, false) THEN 'permission' END,
        CASE WHEN NOT coalesce(role IS NULL OR image_role = role, false) THEN 'image_role' END]) AS code FROM i),
    a AS (SELECT image_id, code FROM v UNION ALL SELECT image_id, 'unknown' FROM e WHERE image_id NOT IN (SELECT image_id FROM images)
        UNION ALL SELECT source_id, 'expected_images' FROM (SELECT source_id, count(*) AS n FROM i GROUP BY 1) LEFT JOIN p USING (source_id) WHERE NOT coalesce(n = expected, false))
    SELECT code, count(*) AS n FROM a WHERE code IS NOT NULL GROUP BY 1""")
def eligibility_violations(spark, folder):
    p = spark.createDataFrame(
        [("tgfc", "CC BY 4.0", "authors", 100, None), ("idphy", "CC0", "gallery", 621, "full_field"), ("soil", " ", "authors", 20, None)],
        "source_id string, license string, attribution string, expected_images int, required_image_role string",
    )
    e = table(spark, folder, "split_manifest").select("image_id").distinct().unionByName(spark.createDataFrame([("no such image",)], "image_id string"))
    return checks.eligibility_violations(table(spark, folder, "images"), e, p).groupBy("code").agg(F.count("*").alias("n"))


# Versions, references and gates


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_event(spark, folder):
    return reviews.latest(table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type", "value"), "user_id", "ts", "event_id").select("user_id", "event_id", "event_type", "value")


@query("SELECT user_id, ts::DATE::VARCHAR AS day, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_versions(spark, folder):
    return checks.repeated(table(spark, folder, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")), "user_id", "day")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def orphan_rows(spark, folder):
    shipped = table(spark, folder, "orders").filter("o_orderstatus = 'F'")
    return checks.orphans(table(spark, folder, "lineitem"), "l_orderkey", shipped, "o_orderkey").select("l_orderkey", "l_linenumber")


@query("""
    WITH ids AS (SELECT image_id_a AS image_id FROM near_pairs UNION ALL SELECT image_id_b FROM near_pairs)
    SELECT image_id, count(*) AS n FROM ids WHERE image_id IS NOT NULL AND image_id NOT IN (SELECT image_id FROM images) GROUP BY 1""")
def unknown_pair_ids(spark, folder):
    sides = table(spark, folder, "near_pairs").select(F.explode(F.array("image_id_a", "image_id_b")).alias("image_id"))
    return checks.orphans(sides, "image_id", table(spark, folder, "images"), "image_id").groupBy("image_id").agg(F.count("*").alias("n"))


@query("""
    SELECT delivery_id, array_to_string(list_filter([CASE WHEN coalesce(trim(relative_path), '') IN ('', '-', 'n/a') THEN 'no_path' END, CASE WHEN NOT coalesce(checksum_verified, false) THEN 'not_verified' END,
        CASE WHEN frame_count IS NULL OR frame_count <> 1 THEN 'not_single_frame' END], lambda x: x IS NOT NULL), '|') AS reasons FROM deliveries""")
def exclusion_reasons(spark, folder):
    return table(spark, folder, "deliveries").select(
        "delivery_id",
        F.array_join(
            flags.flags_where(
                {
                    "no_path": F.coalesce(F.trim("relative_path"), F.lit("")).isin("", "-", "n/a"),
                    "not_verified": ~F.coalesce("checksum_verified", F.lit(False)),
                    "not_single_frame": F.coalesce(F.col("frame_count") != 1, F.lit(True)),
                }
            ),
            "|",
        ).alias("reasons"),
    )


@query("SELECT reason, count(*) AS n FROM (SELECT unnest(import_flags) AS reason FROM images) GROUP BY 1")
def reason_histogram(spark, folder):
    return reviews.histogram(table(spark, folder, "images"), "import_flags")


@query("""
    SELECT s.s AS o_orderstatus, p.p AS o_orderpriority, count(o.o_orderkey) AS n FROM (SELECT DISTINCT o_orderstatus AS s FROM orders) s CROSS JOIN (SELECT DISTINCT o_orderpriority AS p FROM orders) p
    LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 400000) o ON o.o_orderstatus = s.s AND o.o_orderpriority = p.p GROUP BY 1, 2""")
def crosstab_zeros(spark, folder):
    o = table(spark, folder, "orders")
    return reviews.crosstab(o.filter("o_totalprice > 400000"), "o_orderstatus", "o_orderpriority", o, o)


@query("""
    WITH a AS (SELECT DISTINCT image_id FROM split_manifest), b AS (SELECT DISTINCT image_id FROM taxon_labels)
    SELECT count(*) FILTER (b.image_id IS NULL) AS only_left, count(*) FILTER (a.image_id IS NULL) AS only_right, count(*) FILTER (a.image_id IS NOT NULL AND b.image_id IS NOT NULL) AS both
    FROM a FULL JOIN b USING (image_id)""")
def coverage_diff(spark, folder):
    a = table(spark, folder, "split_manifest").select("image_id").distinct().withColumn("l", F.lit(1))
    b = table(spark, folder, "taxon_labels").select("image_id").distinct().withColumn("r", F.lit(1))
    return a.join(b, "image_id", "full_outer").agg(F.count_if(F.expr("r is null")).alias("only_left"), F.count_if(F.expr("l is null")).alias("only_right"), F.count_if(F.expr("l is not null and r is not null")).alias("both"))


@query("SELECT doc_id, image_id FROM documents WHERE image_id IN (SELECT image_id FROM images)")
def eligibility_semi(spark, folder):
    return table(spark, folder, "documents").join(table(spark, folder, "images"), "image_id", "left_semi").select("doc_id", "image_id")


@query("SELECT d.doc_id, coalesce(d.image_id, 'not_linked') AS reason FROM documents d WHERE NOT EXISTS (SELECT 1 FROM images i WHERE i.image_id = d.image_id)")
def eligibility_anti(spark, folder):
    return table(spark, folder, "documents").join(table(spark, folder, "images"), "image_id", "left_anti").select("doc_id", F.coalesce("image_id", F.lit("not_linked")).alias("reason"))


@query("""
    WITH ids AS (SELECT DISTINCT image_id FROM images)
    SELECT i.record_no, i.lineage['parent_image_id'] AS parent_id, ids.image_id IS NULL AS parent_image_missing
    FROM images i LEFT JOIN ids ON ids.image_id = i.lineage['parent_image_id'] WHERE i.lineage['parent_image_id'] IS NOT NULL""")
def fk_self_join(spark, folder):
    i = table(spark, folder, "images")
    known = i.select(F.col("image_id").alias("parent_id")).distinct().withColumn("found", F.lit(True))
    return (
        i.select("record_no", F.col("lineage")["parent_image_id"].alias("parent_id")).filter("parent_id is not null").join(known, "parent_id", "left")
        .select("record_no", "parent_id", F.col("found").isNull().alias("parent_image_missing"))
    )


@query("""
    WITH t AS (SELECT image_id, max(selection_status) AS st FROM images GROUP BY 1)
    SELECT i.record_no, CASE WHEN t.image_id IS NULL THEN 'unknown_canonical_image_id' ELSE 'canonical_image_is_excluded' END AS code
    FROM images i LEFT JOIN t ON t.image_id = i.canonical_image_id WHERE i.canonical_image_id IS NOT NULL AND (t.image_id IS NULL OR t.st = 'excluded_redundant' AND t.st IS NOT NULL)""")
def canonical_references(spark, folder):
    i = table(spark, folder, "images")
    target = i.groupBy("image_id").agg(F.max("selection_status").alias("st")).select(F.col("image_id").alias("canonical_image_id"), "st", F.lit(True).alias("known"))
    joined = i.filter("canonical_image_id is not null").select("record_no", "canonical_image_id").join(target, "canonical_image_id", "left")
    return joined.select("record_no", F.when(F.col("known").isNull(), "unknown_canonical_image_id").when(F.col("st") == "excluded_redundant", "canonical_image_is_excluded").alias("code")).filter("code is not null")


@query("""
    SELECT d.delivery_id, i.image_id IS NULL AS unknown, coalesce(d.source_id <> i.source_id, false) AS source_differs FROM deliveries d
    LEFT JOIN (SELECT image_id, min(source_id) AS source_id FROM split_manifest GROUP BY 1) i USING (image_id)""")
def acquisition_join(spark, folder):
    i = table(spark, folder, "split_manifest").groupBy("image_id").agg(F.min("source_id").alias("s"))
    return table(spark, folder, "deliveries").join(i, "image_id", "left").select("delivery_id", F.col("s").isNull().alias("unknown"), F.coalesce(F.col("source_id") != F.col("s"), F.lit(False)).alias("source_differs"))


@query("""
    WITH a AS (SELECT source_id, count(*) AS actual FROM images GROUP BY 1)
    SELECT a.source_id, p.e AS expected, actual, coalesce(p.l <> '' AND p.e = actual, false) AS complete FROM a LEFT JOIN (VALUES ('tgfc', 'CC BY 4.0', 5266), ('idphy', '', 621)) p(s, l, e) ON p.s = a.source_id""")
def policy_counts(spark, folder):
    p = spark.createDataFrame([("tgfc", "CC BY 4.0", "authors", 5266), ("idphy", "", "gallery", 621)], "source_id string, license string, attribution string, expected_images int")
    return summaries.policy_counts(table(spark, folder, "images"), p)


_UNIQUE = "len({0}) = len(list_distinct({0})) + CASE WHEN len(list_filter({0}, lambda x: x IS NULL)) > 0 THEN 1 ELSE 0 END"
#: Every rule of a record; a rule that is NULL does not hold.
RECORD_RULES = {
    "image_id": "length(trim(image_id)) > 0",
    "source_id": "source_id IN ('tgfc', 'idphy', 'soil')",
    "relative_path": "length(relative_path) > 0 AND NOT starts_with(relative_path, '/') AND NOT contains(relative_path, chr(92)) AND len(list_filter(string_split(relative_path, '/'), lambda x: x IN ('', '.', '..'))) = 0",
    "sha256": "regexp_full_match(sha256, '[0-9a-f]{64}')",
    "pixel_sha256": "pixel_sha256 IS NULL OR regexp_full_match(pixel_sha256, '[0-9a-f]{64}')",
    "lossless_transform_sha256": "lossless_transform_sha256 IS NULL OR regexp_full_match(lossless_transform_sha256, '[0-9a-f]{64}')",
    "perceptual_dhash64": "perceptual_dhash64 IS NULL OR regexp_full_match(perceptual_dhash64, '[0-9a-f]{16}')",
    "bytes": "bytes > 0", "width_px": "width_px > 0", "height_px": "height_px > 0", "frame_count": "frame_count >= 1",
    "selection_status": "selection_status IN ('included', 'excluded_redundant')",
    "exclusion_reason": "CASE WHEN selection_status = 'excluded_redundant' THEN exclusion_reason IN ('exact_file_duplicate', 'exact_pixel_duplicate', 'lossless_transform_duplicate') ELSE exclusion_reason IS NULL END",
    "canonical_image_id": "selection_status <> 'excluded_redundant' OR coalesce(canonical_image_id <> image_id, false)",
    "image_role": "image_role IN ('full_field', 'crop', 'unknown')",
    "candidate_groups": _UNIQUE.format("candidate_groups") + " AND len(list_filter(candidate_groups, lambda x: x IN ('fungi', 'oomycetes'))) = len(candidate_groups)",
    "relationship_keys": _UNIQUE.format("relationship_keys"), "import_flags": _UNIQUE.format("import_flags"),
}


@query(
    "WITH v AS (SELECT record_no, unnest([" + ", ".join(f"CASE WHEN NOT coalesce({rule}, false) THEN '{code}' END" for code, rule in RECORD_RULES.items()) + "]) AS code FROM images)"
    " SELECT record_no, code FROM v WHERE code IS NOT NULL"
)
def record_violations(spark, folder):
    return checks.violations(table(spark, folder, "images"), ["record_no"], checks.record_constraints())


@query(" UNION ALL ".join(f"SELECT '{code}' AS code, count(*) AS n FROM images WHERE NOT coalesce({rule}, false) HAVING count(*) > 0" for code, rule in RECORD_RULES.items()))
def record_constraints(spark, folder):
    return checks.violations(table(spark, folder, "images"), ["record_no"], checks.record_constraints()).groupBy("code").agg(F.count("*").alias("n"))


@query("""
    WITH t AS (SELECT label_id, taxon_group AS g, genus AS n, species AS s, coalesce(taxon_rank, '') AS r FROM taxon_labels),
    v AS (SELECT label_id, unnest([CASE WHEN n IS NOT NULL AND g IS NULL THEN 'genus_without_group' END, CASE WHEN s IS NOT NULL AND NOT coalesce(starts_with(s, n || ' '), false) THEN 'species_without_genus' END,
        CASE WHEN r <> CASE WHEN s IS NOT NULL THEN 'species' WHEN n IS NOT NULL THEN 'genus' WHEN g IS NOT NULL THEN 'group' ELSE 'unresolved' END THEN 'rank_is_not_the_deepest' END]) AS code FROM t)
    SELECT code, count(*) AS n FROM v WHERE code IS NOT NULL GROUP BY 1""")
def hierarchy_constraints(spark, folder):
    t = table(spark, folder, "taxon_labels").select("label_id", F.array(F.struct("source_label", *taxa.RANKS, F.coalesce("taxon_rank", F.lit("")).alias("rank"))).alias("taxa"))
    return checks.taxa_violations(t, "label_id").groupBy("code").agg(F.count("*").alias("n"))


@query("""
    WITH a AS (SELECT image_id, split FROM split_manifest), b AS (SELECT image_id, lower(trim(split)) AS split FROM split_manifest),
    u AS (SELECT image_id, split, 1 AS d FROM a UNION ALL SELECT image_id, split, -1 FROM b)
    SELECT CASE WHEN sum_d > 0 THEN '-' ELSE '+' END AS side, count(*) AS "rows", sum(abs(sum_d))::BIGINT AS n FROM (SELECT image_id, split, sum(d) AS sum_d FROM u GROUP BY 1, 2 HAVING sum(d) <> 0) GROUP BY 1""")
def view_equality(spark, folder):
    m = table(spark, folder, "split_manifest")
    return checks.difference(m.select("image_id", "split"), m.select("image_id", F.lower(F.trim("split")).alias("split"))).groupBy("side").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))


# Summaries


@query("""
    SELECT source_id, count(*) AS images, count(*) FILTER (selection_status = 'included') AS selected, count(*) FILTER (selection_status <> 'included') AS excluded,
           count(DISTINCT sha256) AS unique_hashes, count(DISTINCT leakage_group_id) AS leakage_groups FROM images GROUP BY ROLLUP (source_id)""")
def catalog_summary(spark, folder):
    return summaries.catalog_summary(table(spark, folder, "images"))


@query("""
    SELECT 'image_role' AS dimension, coalesce(image_role, 'unspecified') AS value, count(*) AS n FROM images GROUP BY 2
    UNION ALL SELECT 'source_split', coalesce(source_split, 'unspecified'), count(*) FROM images GROUP BY 2
    UNION ALL SELECT 'candidate_groups', v, count(*) FROM (SELECT unnest(candidate_groups) AS v FROM images) GROUP BY 2
    UNION ALL SELECT 'import_flags', v, count(*) FROM (SELECT unnest(import_flags) AS v FROM images) GROUP BY 2""")
def dimension_counts(spark, folder):
    return summaries.counts_by(table(spark, folder, "images"), "image_role", "source_split", "candidate_groups", "import_flags")


@query("SELECT string_split(relative_path, '/')[1] AS collection, string_split(relative_path, '/')[-2] AS folder, count(*) AS images, sum(bytes)::BIGINT AS bytes FROM images GROUP BY 1, 2")
def inventory_summary(spark, folder):
    i = table(spark, folder, "images").select(paths.first(F.col("relative_path")).alias("collection"), F.col("relative_path").alias("path"), "bytes")
    return summaries.inventory_summary(i)


@query("SELECT image_id, string_agg(genus, ' | ' ORDER BY genus) AS names FROM (SELECT DISTINCT image_id, genus FROM taxon_labels WHERE genus IS NOT NULL) GROUP BY 1")
def joined_names(spark, folder):
    return summaries.joined_names(table(spark, folder, "taxon_labels"), "image_id", "genus")


@query("SELECT count(*) FILTER (image_role = 'full_field') AS full_fields, count(*) FILTER (image_role = 'crop') AS crops FROM images")
def role_counts(spark, folder):
    return table(spark, folder, "images").agg(F.count_if(F.col("image_role") == "full_field").alias("full_fields"), F.count_if(F.col("image_role") == "crop").alias("crops"))


# Scalar functions


@query(r"""
    SELECT record_no, lower(regexp_extract(source_url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
        lower(regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@\s]*@)?([^/:?#\s]+)', 1)) AS host,
        regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]*(/[^?#\s]*)?', 1) AS path FROM images WHERE source_url IS NOT NULL""")
def url_parts(spark, folder):
    u = F.col("source_url")
    return table(spark, folder, "images").filter("source_url is not null").select("record_no", paths.scheme(u).alias("scheme"), paths.host(u).alias("host"), paths.url_path(u).alias("path"))


@query(r"""
    SELECT record_no, string_split(relative_path, '/')[1] AS first, string_split(relative_path, '/')[-2] AS parent, regexp_replace(string_split(relative_path, '/')[-1], '(.)\.[^.]+$', '\1') AS stem,
        lower(regexp_extract(string_split(relative_path, '/')[-1], '^.+(\.[^.]+)$', 1)) AS suffix,
        length(relative_path) > 0 AND NOT starts_with(relative_path, '/') AND position('\' IN relative_path) = 0 AND NOT list_contains(string_split(relative_path, '/'), '..') AS safe
    FROM images WHERE relative_path IS NOT NULL""")
def path_parts(spark, folder):
    p = F.col("relative_path")
    return table(spark, folder, "images").filter("relative_path is not null").select(
        "record_no", paths.first(p).alias("first"), paths.parent(p).alias("parent"), paths.stem(p).alias("stem"), paths.suffix(p).alias("suffix"), paths.is_safe(p).alias("safe")
    )


@query("""
    WITH k AS (SELECT record_no, replace(unnest(relationship_keys), ':', ' ') AS c FROM images),
    r AS (SELECT record_no, 'CBS' AS namespace, unnest(regexp_extract_all(c, '(?i)\\bCBS\\s+(\\d+(?:\\.\\d+)?)\\b', 1)) AS identifier FROM k UNION ALL
          SELECT record_no, 'SE', unnest(regexp_extract_all(c, '(?i)\\bSE\\s+(\\d+)\\b', 1)) FROM k UNION ALL SELECT record_no, 'RHS', unnest(regexp_extract_all(c, '(?i)\\bRHS\\s+(\\d+(?:\\.\\d+)?)\\b', 1)) FROM k UNION ALL
          SELECT record_no, 'PH', unnest(regexp_extract_all(c, '(?i)\\bPH\\s?(\\d+)\\b', 1)) FROM k UNION ALL SELECT record_no, 'VI', unnest(regexp_extract_all(c, '(?i)\\bVI\\s+(\\d+-[A-Z0-9]+)\\b', 1)) FROM k)
    SELECT record_no, namespace, identifier, 'idphy:culture:' || namespace || ':' || identifier AS relationship_key FROM r""".replace("\\\\", "\\"))
def code_references(spark, folder):
    k = table(spark, folder, "images").select("record_no", F.lit("relationship_keys").alias("source_field"), F.explode("relationship_keys").alias("caption"))
    k = k.withColumn("caption", F.translate("caption", ":", " "))
    return codes.caption_references(k, "record_no").select("record_no", "namespace", "identifier", "relationship_key")


@query(r"""
    SELECT doc_id, rule FROM (SELECT doc_id, unnest([CASE WHEN regexp_matches(text, '(?i)/(?:Users|home)/[A-Za-z0-9._-]+(?:/|\b)|/(?:Volumes)/[A-Za-z0-9][^\r\n"''`<>]*|[A-Za-z]:[\\/](?:Users|Documents and Settings)[\\/][^\s\\/"'']+') THEN 'personal-machine-path' END,
        CASE WHEN regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') THEN 'email-address' END, CASE WHEN regexp_matches(text, '(?i)https?://[^/\s@]+@') THEN 'authenticated-url' END]) AS rule FROM documents) WHERE rule IS NOT NULL""")
def text_scan_findings(spark, folder):
    return table(spark, folder, "documents").filter("text is not null").select("doc_id", F.explode(scan.text_findings(F.col("text"))).alias("rule"))


@query(r"""
    WITH t AS (SELECT l_orderkey, l_linenumber, [(l_linenumber % 4)::VARCHAR, l_discount::VARCHAR, l_tax::VARCHAR, (l_quantity / 50)::VARCHAR, (l_discount * 2)::VARCHAR] AS x FROM lineitem)
    SELECT l_orderkey, l_linenumber, x[1]::INT AS class_id, CASE WHEN x[4]::DOUBLE NOT BETWEEN 0 AND 1 THEN 'outside' WHEN x[4]::DOUBLE <= 0 OR x[5]::DOUBLE <= 0 THEN 'empty_box' END AS error FROM t""")
def box_parse(spark, folder):
    c = F.col
    lines_ = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat_ws(" ", (c("l_linenumber") % 4).cast("string"), c("l_discount"), c("l_tax"), c("l_quantity") / 50, c("l_discount") * 2).alias("text")
    )
    return boxes.boxes(lines_, "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber", "class_id", "error")


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, sha256('{\"event_type\":' || to_json(event_type) || ',\"user_id\":' || user_id || '}') AS object_hash FROM events")
def json_props(spark, folder):
    e = table(spark, folder, "events")
    return e.select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), ids.object_hash({"user_id": F.col("user_id"), "event_type": F.col("event_type")}).alias("object_hash")
    )


@query("SELECT event_id, CASE WHEN NOT json_valid(props) THEN 'invalid_json' WHEN len(list_filter(json_keys(props), lambda x: x <> 'k')) > 0 THEN 'unknown_field' END AS error FROM events")
def strict_lines(spark, folder):
    return table(spark, folder, "events").select("event_id", lines.line_error(F.col("props"), ["k"]).alias("error"))


@query(r"""
    WITH h AS (SELECT record_no, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('lamella:' || source_id || ':' || relative_path)) AS d FROM images WHERE relative_path IS NOT NULL AND source_id IS NOT NULL)
    SELECT record_no, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-' || ['8', '9', 'a', 'b'][(('0x' || substr(d, 17, 1))::INT % 4) + 1] || substr(d, 18, 3) || '-' || substr(d, 21, 12) AS id FROM h""")
def uuid5_ids(spark, folder):
    i = table(spark, folder, "images").filter("relative_path is not null and source_id is not null")
    return i.select("record_no", ids.row_id(F.col("source_id"), F.col("relative_path")).alias("id"))


@query("""
    SELECT record_no, array_to_string(list_sort(list_distinct(list_concat(list_filter(coalesce(import_flags, []), lambda x: x NOT IN ('multi_frame_asset', 'native_dimension_below_224')),
        list_filter([CASE WHEN frame_count > 1 THEN 'multi_frame_asset' END, CASE WHEN least(width_px, height_px) < 500 THEN 'native_dimension_below_224' END], lambda x: x IS NOT NULL)))), '|') AS flags FROM images""")
def derived_flags(spark, folder):
    bare = flags.drop_flags(F.col("import_flags"), "multi_frame_asset", "native_dimension_below_224")
    derived = {"multi_frame_asset": F.col("frame_count") > 1, "native_dimension_below_224": F.least("width_px", "height_px") < 500}
    return table(spark, folder, "images").select("record_no", F.array_join(flags.add_flags(flags.sorted_set(bare), derived), "|").alias("flags"))


@query("SELECT source_id, relative_path, bytes, NULL AS feed FROM images UNION ALL SELECT source_id, relative_path, NULL, feed FROM deliveries")
def source_union(spark, folder):
    """Feeds of different columns, every row kept."""
    feeds = table(spark, folder, "images").select("source_id", "relative_path", "bytes"), table(spark, folder, "deliveries").select("source_id", "relative_path", "feed")
    return feeds[0].unionByName(feeds[1], allowMissingColumns=True)


@query("SELECT '{\"batch_no\":' || coalesce(batch_no::VARCHAR, 'null') || ',\"frame_count\":' || coalesce(frame_count::VARCHAR, 'null') || ',\"record_no\":' || record_no || '}' AS line FROM images")
def canonical_lines(spark, folder):
    return table(spark, folder, "images").select(ids.canonical_json({c: F.col(c) for c in ("record_no", "batch_no", "frame_count")}).alias("line"))


@query(f"SELECT record_no, {sha_sql('sha256')} AS sha256 FROM images")
def digest_forms(spark, folder):
    return table(spark, folder, "images").select("record_no", sha256_hex(F.col("sha256")).alias("sha256"))


@query("SELECT doc_id, coalesce(nullif(lower(trim(lang)), ''), 'und') AS lang, coalesce(nullif(source, ''), doc_kind, 'unknown') AS origin FROM documents")
def provenance_chain(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", F.coalesce(F.nullif(stripped(F.col("lang")), F.lit("")), F.lit("und")).alias("lang"), F.coalesce(F.nullif("source", F.lit("")), "doc_kind", F.lit("unknown")).alias("origin")
    )


# Further joins, filters, sets and projections


@query(r"""
    WITH t AS (SELECT l_orderkey, l_linenumber, l_linenumber % 4 AS class_id FROM lineitem), c AS (SELECT * FROM (VALUES (0, 'a'), (1, 'b'), (2, 'c')) v(class_id, label))
    SELECT l_orderkey, l_linenumber, label, CASE WHEN label IS NULL THEN 'unknown_class' END AS error FROM t LEFT JOIN c USING (class_id)""")
def box_labels(spark, folder):
    classes = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "class_id int, label string")
    found = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.concat_ws(" ", (F.col("l_linenumber") % 4).cast("string"), F.lit("0.5 0.5 0.25 0.25")).alias("text"))
    return boxes.labelled_boxes(boxes.boxes(found, "l_orderkey", "l_linenumber"), F.broadcast(classes)).select("l_orderkey", "l_linenumber", "label", "error")


@query("""
    WITH g AS (SELECT leakage_group_id, min(lower(trim(split))) AS split FROM split_manifest WHERE leakage_group_id IS NOT NULL GROUP BY 1),
    m AS (SELECT DISTINCT image_id, leakage_group_id FROM split_manifest)
    SELECT d.doc_id, m.leakage_group_id, g.split FROM documents d JOIN m USING (image_id) LEFT JOIN g USING (leakage_group_id)""")
def group_split_join(spark, folder):
    m = table(spark, folder, "split_manifest")
    g = m.filter("leakage_group_id is not null").groupBy("leakage_group_id").agg(F.min(F.lower(F.trim("split"))).alias("split"))
    placed = m.select("image_id", "leakage_group_id").distinct()
    return table(spark, folder, "documents").select("doc_id", "image_id").join(placed, "image_id").join(g, "leakage_group_id", "left").select("doc_id", "leakage_group_id", "split")


@query("SELECT DISTINCT leakage_group_id FROM split_manifest WHERE leakage_group_id IS NOT NULL AND leakage_group_id NOT IN (SELECT leakage_group_id FROM split_manifest WHERE leakage_group_id IS NOT NULL AND split = 'train')")
def unassigned_groups(spark, folder):
    m = table(spark, folder, "split_manifest").filter("leakage_group_id is not null")
    return checks.orphans(m, "leakage_group_id", m.filter("split = 'train'"), "leakage_group_id").select("leakage_group_id").distinct()


@query("""
    WITH a AS (SELECT DISTINCT image_id FROM split_manifest), b AS (SELECT DISTINCT image_id FROM images)
    SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS missing, (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS extra""")
def set_equality(spark, folder):
    a, b = (table(spark, folder, t).select("image_id").distinct() for t in ("split_manifest", "images"))
    d = checks.difference(a, b)
    return d.agg(F.coalesce(F.sum(F.when(F.col("side") == "-", 1)), F.lit(0)).alias("missing"), F.coalesce(F.sum(F.when(F.col("side") == "+", 1)), F.lit(0)).alias("extra"))


@query("SELECT record_no FROM images WHERE frame_count = 1 AND selection_status = 'included' AND source_split = 'valid'")
def partition_filter(spark, folder):
    return table(spark, folder, "images").filter("frame_count = 1 and selection_status = 'included' and source_split = 'valid'").select("record_no")


@query(f"WITH {RECORDS_SQL} SELECT record_no, lower(lpad(to_hex(dhash), 16, '0')) AS dhash, bit_count(dhash)::INT AS bits FROM rec WHERE bit_count(dhash) BETWEEN 4 AND 60")
def informative_hashes(spark, folder):
    r = records(table(spark, folder, "images")).filter(hashing.is_informative(F.col("dhash")))
    return r.select("record_no", hashing.hex64(F.col("dhash")).alias("dhash"), F.bit_count("dhash").alias("bits"))


@query("""
    SELECT record_no, coalesce(len(list_filter(import_flags, lambda x: x NOT IN ('multi_frame_asset', 'source_label_unreviewed'))) = 0, true) AS subset,
        len(import_flags) = len(list_distinct(import_flags)) AS is_unique FROM images WHERE import_flags IS NOT NULL""")
def flag_sets(spark, folder):
    allowed = F.array(F.lit("multi_frame_asset"), F.lit("source_label_unreviewed"))
    return table(spark, folder, "images").filter("import_flags is not null").select("record_no", flags.is_subset(F.col("import_flags"), allowed).alias("subset"), flags.is_unique(F.col("import_flags")).alias("is_unique"))


@query("""
    SELECT DISTINCT doc_id, rule FROM (SELECT doc_id, 'long_text' AS rule FROM documents WHERE n_chars > 2000 UNION ALL SELECT doc_id, 'no_language' FROM documents WHERE lang IS NULL OR lang = 'und'
        UNION ALL SELECT doc_id, 'no_language' FROM documents WHERE lang IS NULL)""")
def findings_union(spark, folder):
    d = table(spark, folder, "documents")
    first = d.select("doc_id", F.explode(flags.flags_where({"long_text": F.col("n_chars") > 2000, "no_language": F.col("lang").isNull() | (F.col("lang") == "und")})).alias("rule"))
    return first.union(d.filter("lang is null").select("doc_id", F.lit("no_language").alias("rule"))).distinct()


@query("""
    SELECT record_no, candidate_groups[1] AS candidate_group, CASE candidate_groups[1] WHEN 'fungi' THEN 0 WHEN 'oomycetes' THEN 1 END AS class_id
    FROM images WHERE selection_status = 'included' AND len(candidate_groups) = 1""")
def working_examples(spark, folder):
    ids_of = F.create_map(*(F.lit(x) for p in taxa.GROUPS.items() for x in p))
    i = table(spark, folder, "images").filter((F.col("selection_status") == "included") & (F.size("candidate_groups") == 1))
    return i.select("record_no", F.col("candidate_groups")[0].alias("candidate_group")).withColumn("class_id", F.try_element_at(ids_of, F.col("candidate_group")))


@query("SELECT record_no, to_json(candidate_groups)::VARCHAR AS candidate_groups, to_json(import_flags)::VARCHAR AS import_flags FROM images WHERE candidate_groups IS NOT NULL AND import_flags IS NOT NULL")
def csv_projection(spark, folder):
    from lamella.sources.sinks import csv_ready

    return csv_ready(table(spark, folder, "images").filter("candidate_groups is not null and import_flags is not null").select("record_no", "candidate_groups", "import_flags"))


@query(r"""
    WITH n AS (SELECT record_no, regexp_replace(string_split(relative_path, '/')[-1], '(.)\.[^.]+$', '\1') AS stem FROM images WHERE relative_path IS NOT NULL)
    SELECT record_no, string_split(stem, '_')[1] AS label, array_to_string(string_split(stem, '_')[1:2], '_') AS parent_id, CASE WHEN len(string_split(stem, '_')) > 2 THEN 'crop' ELSE 'full_field' END AS role FROM n""")
def sample_names(spark, folder):
    i = table(spark, folder, "images").filter("relative_path is not null")
    return i.select("record_no", paths.sample_name(paths.name(F.col("relative_path"))).alias("s")).select("record_no", "s.*")


@query("SELECT delivery_id, lower(split_part(sha256, ':', 1)) AS algorithm, lower(split_part(sha256, ':', 2)) AS value FROM deliveries WHERE starts_with(sha256, 'sha256:')")
def named_digests(spark, folder):
    d = table(spark, folder, "deliveries").filter(F.col("sha256").startswith("sha256:"))
    return d.select("delivery_id", paths.named_digest(F.col("sha256")).alias("d")).select("delivery_id", "d.*")


@query("""
    SELECT p.o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_custkey, sha256('[42,"' || o_orderkey || '"]')) AS place FROM orders p""")
def priority_order(spark, folder):
    tie = F.sha2(F.concat(F.lit('[42,"'), F.col("o_orderkey").cast("string"), F.lit('"]')), 256)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_custkey")
    return ranking.places(orders, "o_orderpriority", [F.desc("o_totalprice"), F.col("o_custkey"), tie]).select("o_orderkey", "place")


@query("""
    WITH t AS (SELECT DISTINCT record_no AS node, unnest(relationship_keys) AS token FROM images), h AS (SELECT token, min(node) AS u FROM t WHERE token IS NOT NULL GROUP BY 1)
    SELECT u, node AS v FROM t JOIN h USING (token) WHERE node <> u""")
def star_edges(spark, folder):
    tokens = table(spark, folder, "images").select(F.col("record_no").alias("node"), F.explode("relationship_keys").alias("token")).filter("token is not null").distinct()
    return graph.star_edges(tokens)


def _raster_rows(spark, folder):
    """The embeddings as 8 x 8 grey images."""
    v = F.transform("embedding", lambda x: F.least(F.greatest(F.round((x + 1) * 127.5), F.lit(0)), F.lit(255)).cast("int"))
    data = F.unhex(F.array_join(F.transform(v, lambda x: F.lpad(F.hex(x), 2, "0")), ""))
    return table(spark, folder, "embeddings").filter("embedding is not null").select("vec_id", F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("nChannels"), data.alias("data"))


def _symmetry_sql() -> str:
    """For each flip and rotation of an 8 x 8 image, the places its pixels come from, as a list of lists."""
    maps = [lambda r, c: (r, c), lambda r, c: (c, 7 - r), lambda r, c: (7 - r, 7 - c), lambda r, c: (7 - c, r)]
    places = [[8 * y + x + 1 for r in range(8) for c in range(8) for y, x in [turn(r, 7 - c if mirrored else c)]] for turn in maps for mirrored in (False, True)]
    return str(places)


@query(f"""
    WITH g AS (SELECT vec_id, list_transform(embedding, lambda x: printf('%02x', least(greatest(round((x + 1::FLOAT)::DOUBLE * 127.5::DOUBLE), 0), 255)::INT)) AS g FROM embeddings WHERE embedding IS NOT NULL),
    h AS (SELECT vec_id, list_transform({_symmetry_sql()}, lambda p: sha256(encode('rgb-pixels-v1:8:8:') || unhex(array_to_string(list_transform(p, lambda i: g[i] || g[i] || g[i]), '')))) AS h FROM g)
    SELECT vec_id, h[1] AS pixel_sha256, list_min(h) AS lossless_transform_sha256 FROM h""")
def raster_hashes(spark, folder):
    return raster_fingerprints(spark, folder).drop("perceptual_dhash64")


@query()
def raster_fingerprints(spark, folder):
    from lamella.sources import rasters

    def work(batches):
        import pandas as pd

        for b in batches:
            yield pd.DataFrame([(i, *rasters.fingerprints(rasters.rgb_array(d, 8, 8, 1))) for i, d in zip(b["vec_id"], b["data"])], columns=["vec_id", "pixel_sha256", "lossless_transform_sha256", "perceptual_dhash64"])

    return _raster_rows(spark, folder).mapInPandas(work, "vec_id bigint, pixel_sha256 string, lossless_transform_sha256 string, perceptual_dhash64 string")


@query("""
    WITH g AS (SELECT vec_id, list_transform(embedding, lambda x: least(greatest(round((x + 1::FLOAT)::DOUBLE * 127.5::DOUBLE), 0), 255)) AS g FROM embeddings WHERE embedding IS NOT NULL),
    place AS (SELECT i, (i + 0.5::DOUBLE) / 2 - 0.5::DOUBLE AS x FROM range(16) r(i)),
    near AS (SELECT i, least(greatest(floor(x) + k, 0), 7)::INT AS s, abs(x - (floor(x) + k)) AS d FROM place, range(-1, 3) q(k)),
    w AS (SELECT i, s, sum(CASE WHEN d <= 1 THEN 1.25::DOUBLE * d * d * d - 2.25::DOUBLE * d * d + 1 WHEN d < 2 THEN -0.75::DOUBLE * d * d * d + 3.75::DOUBLE * d * d - 6 * d + 3 ELSE 0 END) AS w FROM near GROUP BY 1, 2),
    v AS (SELECT vec_id, a.i, b.i AS j, least(greatest(round_even(sum(a.w * b.w * g[8 * a.s + b.s + 1]), 0), 0), 255)::FLOAT AS v FROM g, w a, w b GROUP BY 1, 2, 3),
    n(m, d) AS (VALUES (0.485::FLOAT, 0.229::FLOAT), (0.456::FLOAT, 0.224::FLOAT), (0.406::FLOAT, 0.225::FLOAT))
    SELECT vec_id, count(*) AS "values", round(sum(((v / 255::FLOAT - m) / d)::DOUBLE), 3) AS total FROM v, n GROUP BY 1""")
def image_tensors(spark, folder):
    from lamella.sources import rasters

    t = rasters.tensors(_raster_rows(spark, folder), ["vec_id"], "vec_id bigint", rasters.TensorConfig(16))
    total = F.aggregate("value", F.lit(0.0), lambda a, x: a + x)
    return t.select("vec_id", F.size("value").alias("values"), F.round(total, 3).alias("total"))
