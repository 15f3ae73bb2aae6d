"""SQL that the queries are held against, for those SQL can express on whole tables."""

from __future__ import annotations

_BARE = r"regexp_replace(regexp_replace({0}, '^\s*sha-?256\s*[:=-]', '', 'i'), '\s', '', 'g')"
_HEX = "replace(replace(lower({0}), ':', ''), '-', '')"
_CODED = "regexp_full_match({0}, '[A-Za-z0-9+/_-]{{42}}[AEIMQUYcgkosw048]=?')"
_DIGEST = (
    f"CASE WHEN regexp_full_match({_HEX}, '[0-9a-f]{{{{64}}}}') THEN {_HEX} "
    f"WHEN {_CODED} THEN lower(hex(from_base64(rpad(replace(replace({{0}}, '-', '+'), '_', '/'), 44, '=')))) END"
)

P1 = f"""
    WITH b AS (SELECT record_no, batch_no, frame_count, {_BARE.format('sha256')} AS s, {_BARE.format('pixel_sha256')} AS p,
        regexp_replace(regexp_replace(lower(perceptual_dhash64), '^\\s*0x', ''), '[\\s:_-]', '', 'g') AS h FROM images),
    v AS MATERIALIZED (SELECT record_no, batch_no, {_DIGEST.format('s')} AS s, CASE WHEN frame_count = 1 THEN {_DIGEST.format('p')} END AS p,
        CASE WHEN regexp_full_match(h, '[0-9a-f]{{16}}') THEN ('0x' || h)::UBIGINT WHEN regexp_full_match(h, '[01]{{64}}') THEN h::BIT::UBIGINT END AS h FROM b),
    i AS MATERIALIZED (SELECT record_no, batch_no, h FROM v WHERE bit_count(h) BETWEEN 4 AND 60)
    SELECT a.record_no AS record_no_a, b.record_no AS record_no_b FROM v a JOIN v b ON a.s = b.s AND a.record_no < b.record_no AND a.batch_no <> b.batch_no
    UNION SELECT a.record_no, b.record_no FROM v a JOIN v b ON a.p = b.p AND a.record_no < b.record_no AND a.batch_no <> b.batch_no
    UNION SELECT a.record_no, b.record_no FROM i a JOIN i b ON a.record_no < b.record_no AND a.batch_no <> b.batch_no AND bit_count(xor(a.h, b.h)) <= 2"""

P1_LATEST = f"""
    WITH pairs AS ({P1}), newest AS (SELECT record_no FROM images WHERE batch_no = (SELECT max(batch_no) FROM images)),
    found AS (SELECT record_no_a AS record_no, record_no_b AS other FROM pairs UNION SELECT record_no_b, record_no_a FROM pairs)
    SELECT record_no, count(*) AS earlier_records, min(other) AS first_record FROM found WHERE record_no IN (SELECT record_no FROM newest) GROUP BY 1"""

_FIELDS = ("relative_path", "sha256", "pixel_sha256", "lossless_transform_sha256")
_ORDER = "ORDER BY coalesce(checksum_verified, false) DESC, delivered_at DESC NULLS LAST, delivery_id DESC"
P3 = (
    "WITH "
    + ", ".join(
        f"f_{f} AS (SELECT image_id, {f} AS x FROM deliveries WHERE lower(trim({f}, E' \\t\\n\\r')) NOT IN ('', '-', 'n/a') QUALIFY row_number() OVER (PARTITION BY image_id {_ORDER}) = 1)" for f in _FIELDS
    )
    + f", f_frames AS (SELECT image_id, frame_count AS x FROM deliveries WHERE frame_count IS NOT NULL QUALIFY row_number() OVER (PARTITION BY image_id {_ORDER}) = 1)"
    + f""", r0 AS (SELECT i.image_id, a.x AS path, {_BARE.format('b.x')} AS s, {_BARE.format('c.x')} AS p, {_BARE.format('d.x')} AS l, e.x AS frames FROM (SELECT DISTINCT image_id FROM deliveries) i
        LEFT JOIN f_relative_path a USING (image_id) LEFT JOIN f_sha256 b USING (image_id) LEFT JOIN f_pixel_sha256 c USING (image_id) LEFT JOIN f_lossless_transform_sha256 d USING (image_id) LEFT JOIN f_frames e USING (image_id)),
    r AS (SELECT image_id, path, {_DIGEST.format('s')} AS s, {_DIGEST.format('p')} AS p, {_DIGEST.format('l')} AS l, frames FROM r0),
    k AS (SELECT *, CASE WHEN frames = 1 THEN 'l' || l ELSE 's' || s END AS g FROM r),
    c AS (SELECT g, image_id AS cid, s AS cs, p AS cp FROM k WHERE g IS NOT NULL QUALIFY row_number() OVER (PARTITION BY g ORDER BY path NULLS LAST, image_id) = 1)
    SELECT k.image_id, cid AS canonical_image_id, CASE WHEN s = cs THEN 'exact_file_duplicate' WHEN p = cp THEN 'exact_pixel_duplicate' ELSE 'lossless_transform_duplicate' END AS exclusion_reason
    FROM k JOIN c USING (g) WHERE k.image_id <> cid"""
)

_NAMED = "CASE WHEN lower(trim({0}, E' \\t\\n\\r')) NOT IN ('', '-', '?', 'n/a', 'none', 'unknown', 'not recorded') THEN lower(trim({0}, E' \\t\\n\\r')) END"
P4 = f"""
    WITH RECURSIVE img AS (SELECT lower(trim(image_id)) AS id, source_id, canonical_image_id, relationship_keys, lineage FROM images WHERE image_id IS NOT NULL),
    t AS (SELECT id, 'k' || {_NAMED.format('k')} AS token FROM (SELECT id, unnest(relationship_keys) AS k FROM img)
        UNION SELECT id, 'l' || e.key || chr(1) || CASE WHEN e.key = 'source_parent_id' THEN source_id ELSE '' END || chr(1) || {_NAMED.format('e.value')} FROM (SELECT id, source_id, unnest(map_entries(lineage)) AS e FROM img) WHERE e.key <> 'parent_image_id'),
    refs AS (SELECT id, {_NAMED.format("lineage['parent_image_id']")} AS r FROM img UNION SELECT id, {_NAMED.format('canonical_image_id')} FROM img
        UNION SELECT {_NAMED.format('image_id_a')}, {_NAMED.format('image_id_b')} FROM near_pairs WHERE coalesce(lower(trim(status)), '') <> 'rejected'),
    e AS MATERIALIZED (SELECT DISTINCT h.hub AS u, t.id AS v FROM t JOIN (SELECT token, min(id) AS hub FROM t GROUP BY 1) h USING (token) WHERE h.hub <> t.id
        UNION SELECT r, id FROM refs WHERE r <> id AND r IN (SELECT id FROM img) AND id IN (SELECT id FROM img)),
    b AS MATERIALIZED (SELECT u, v FROM e UNION SELECT v, u FROM e),
    reach AS (SELECT DISTINCT u AS a, u AS z FROM b UNION SELECT reach.a, b.v FROM reach JOIN b ON reach.z = b.u)
    SELECT min(z) AS group_image_id, a AS image_id FROM reach GROUP BY a"""

P4_GROUPS = f"""
    WITH RECURSIVE found AS MATERIALIZED ({P4}), every AS (SELECT DISTINCT image_id FROM images WHERE trim(image_id) <> '')
    SELECT every.image_id, 'lg-' || substr(sha256(coalesce(found.group_image_id, every.image_id)), 1, 16) AS leakage_group_id FROM every LEFT JOIN found USING (image_id)"""

_LATEST = r"""
    WITH n AS (SELECT image_id, assigned_at, assignment_no, regexp_replace(regexp_replace(lower(leakage_group_id), '\s+', '', 'g'), '^lg[-_:]?', '') AS g0, lower(trim(split, E' \t\n\r')) AS s0 FROM split_manifest WHERE image_id IS NOT NULL),
    m AS (SELECT *, CASE WHEN regexp_full_match(g0, '[0-9a-f]{16}') THEN 'lg-' || g0 END AS g, CASE WHEN s0 IN ('train', 'training') THEN 'train' WHEN s0 IN ('val', 'valid', 'validation', 'dev') THEN 'validation' WHEN s0 IN ('test', 'testing') THEN 'test' END AS s FROM n),
    l AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY assigned_at DESC NULLS LAST, (g IS NOT NULL AND s IS NOT NULL)::INT DESC, assignment_no DESC) = 1)"""
P5 = _LATEST + " SELECT g AS leakage_group_id FROM l WHERE g IS NOT NULL AND s IS NOT NULL GROUP BY 1 HAVING count(DISTINCT s) > 1"
#: What any split of the images must hold.
P5_CHECK = _LATEST + " SELECT count(*) AS images, count(DISTINCT coalesce(g, 'image:' || image_id)) AS components, 0 AS torn, 0 AS unassigned, true AS near_target FROM l"


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1, "p1_latest_batch": P1_LATEST, "p3_found": P3, "p4_found": P4, "p4_leakage_groups": P4_GROUPS, "p5_found": P5, "p5_split_check": P5_CHECK}
