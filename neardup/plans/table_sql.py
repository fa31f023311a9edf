"""The same results in DuckDB SQL, for checking the table queries."""

from __future__ import annotations

from neardup.config import SIM_DECIMALS, eps_name
from neardup.plans.table_queries import (
    CHUNK_LIMIT,
    DIM,
    DOC_CHUNK_LIMIT,
    DOC_EPS,
    LINE_EPS,
    TOKENS,
    WIDE_EPS,
)

_VEC = "vec as (select vec_id as id, label, embedding::double[] as v from embeddings)"

_DOC = """
words as (
  select doc_id as id, unnest(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+')) as w
  from documents),
hits as (
  select id, ('0x' || substr(md5(w), 1, 4))::int % 64 as b, count(*) as n
  from words where w <> '' group by 1, 2),
raw as (
  select d.doc_id as id, d.lang, d.n_chars::int as n_chars,
         list(coalesce(h.n, 0)::double order by g.b) as v
  from documents d cross join (select unnest(range(64)) as b) g
  left join hits h on h.id = d.doc_id and h.b = g.b
  group by 1, 2, 3),
doc as (
  select id, lang, n_chars,
         list_transform(v, lambda x: x / greatest(sqrt(list_inner_product(v, v)), 1e-12)) as v
  from raw)"""


def _means(src: str, key: str, out: str, unit: bool) -> str:
    """Mean vector per key of ``src(key, v)`` as ``out(cluster_id, c)``."""
    scaled = "list_transform(m, lambda x: x / greatest(sqrt(list_inner_product(m, m)), 1e-12))"
    return f"""
{out}_long as (
  select {key} as cluster_id, i, avg(x) as x
  from (select {key}, unnest(v) as x, generate_subscripts(v, 1) as i from {src}) group by 1, 2),
{out}_mean as (select cluster_id, list(x order by i) as m from {out}_long group by 1),
{out} as (select cluster_id::int as cluster_id, {scaled if unit else "m"} as c from {out}_mean)"""


def _nearest_ip(src: str, cents: str, out: str) -> str:
    return f"""
{out}_all as (
  select s.id, s.v, c.cluster_id, round(list_inner_product(s.v, c.c), {SIM_DECIMALS}) as score
  from {src} s cross join {cents} c),
{out} as (
  select id, v, cluster_id, score, round(1 - score, {SIM_DECIMALS}) as dist from {out}_all
  qualify row_number() over (partition by id order by score desc, cluster_id) = 1)"""


_SQ = "list_sum(list_transform(range(1, len(s.v) + 1), lambda i: (s.v[i] - c.c[i]) * (s.v[i] - c.c[i])))"

_LABEL_DIST = f"""
{_VEC}, {_means("vec", "label", "cent", False)},
placed as (
  select s.id, s.v, s.label as cluster_id,
         round(1 - list_inner_product(s.v, c.c)
           / (greatest(sqrt(list_inner_product(s.v, s.v)), 1e-8)
              * greatest(sqrt(list_inner_product(c.c, c.c)), 1e-8)), {SIM_DECIMALS}) as dist
  from vec s join cent c on c.cluster_id = s.label)"""


def _ranked(src: str, key: str, order: str, out: str = "ranked") -> str:
    return f"{out} as (select *, row_number() over (partition by {key} order by {order}) as rank from {src})"


def _prior(src: str, by: list[str], rank: str, out: str = "prior") -> str:
    """``out``: every row of ``src`` with ``max_sim``, ``mate_id``, ``mate_rank``."""
    same = " and ".join(f"a.{c} = b.{c}" for c in by)
    return f"""
{out}_pairs as (
  select a.id as i, a.{rank} as ri, b.id as j,
         round(list_inner_product(a.v, b.v), {SIM_DECIMALS}) as s
  from {src} a join {src} b on {same} and a.{rank} < b.{rank}),
{out}_best as (
  select j, max(s) as m, max_by(i, row(s, -ri)) as mate_id, max_by(ri, row(s, -ri)) as mate_rank
  from {out}_pairs group by j),
{out} as (
  select t.*, greatest(coalesce(m, 0), 0)::double as max_sim,
         case when m > 0 then mate_id end as mate_id,
         case when m > 0 then mate_rank end as mate_rank
  from {src} t left join {out}_best on j = t.id)"""


def _eps_rows(eps) -> str:
    return "(values " + ", ".join(f"({e!r}::double)" for e in eps) + ") as e(eps)"


_LANG_PRIOR = f"{_DOC}, {_prior('doc', ['lang'], 'id')}"
_LABEL_RANKED = f"{_LABEL_DIST}, {_ranked('placed', 'cluster_id', 'dist desc, id')}"
_LABEL_PRIOR = f"{_LABEL_RANKED}, {_prior('ranked', ['cluster_id'], 'rank')}"
_ASSIGNED = f"{_VEC}, {_means('vec', 'label', 'cent', True)}, {_nearest_ip('vec', 'cent', 'placed')}"
_OTHERS = """
others as (
  select a.label as cluster_id, a.id, list_inner_product(a.v, b.v) as s
  from vec a join vec b on a.label = b.label and a.id <> b.id)"""


def _chunk(rank: str, n: str, limit: int) -> str:
    chunks = f"ceil({n} / {limit}::double)::bigint"
    return (
        f"len(list_filter(range(1, {chunks}), "
        f"lambda i: floor(i * ({n}::double / {chunks})) <= {rank} - 1))"
    )


def _std(n: str, s: str, q: str) -> str:
    """Sample deviation of the full matrix from sums over ordered pairs."""
    return f"sqrt(({q} - {s} * {s} / ({n} * {n})) / ({n} * {n} - 1))"


def table_sql() -> dict[str, str]:
    elements = "select id, (i - 1)::int as dim, round(x, 6) as value from"
    sql = {
        "scan_vectors": f"""with {_VEC}
            select id, label, len(v)::int as n_dims, round(list_sum(v), 6) as total from vec""",
        "raw_vectors_round_trip": f"""with {_VEC}
            select row_number() over (order by id) - 1 as id, len(v)::int as n_dims,
              round(list_sum(v), 6) as total from vec""",
        "fixed_width_ids_round_trip": """select row_number() over (order by vec_id) - 1 as id,
            'item/' || label || '/' || vec_id as path from embeddings""",
        "vector_ids": "select vec_id as id, vec_id::varchar as path from embeddings",
        "corpus_lines": """select row_number() over (order by doc_id) - 1 as line_no, doc_id, text
            from documents""",
        "embed_hashed": f"""with {_DOC} {elements}
            (select id, unnest(v) as x, generate_subscripts(v, 1) as i from doc)""",
        "l2_normalize": f"""with {_VEC},
            scaled as (select id, list_transform(v, lambda x: x * (label + 2)) as v from vec),
            unit as (select id, list_transform(v, lambda x:
              x / greatest(sqrt(list_inner_product(v, v)), 1e-12)) as v from scaled)
            {elements}
            (select id, unnest(v) as x, generate_subscripts(v, 1) as i from unit)""",
        "last_token_pool": f"""with {_VEC},
            last as (select label, max_by(v, id) as v from vec group by label)
            select label, (i - 1)::int as dim, round(x, 6) as value from
            (select label, unnest(v) as x, generate_subscripts(v, 1) as i from last)""",
        "dist_cosine": f"with {_LABEL_DIST} select id, cluster_id, round(dist, 6) as dist from placed",
        "dist_spherical": f"with {_ASSIGNED} select id, cluster_id, round(dist, 6) as dist from placed",
        "dist_l2": f"""with {_VEC}, {_means("vec", "label", "cent", False)}
            select s.id, c.cluster_id, round({_SQ}, 6) as sq_dist
            from vec s join cent c on c.cluster_id = s.label""",
        "assign_ip": f"with {_ASSIGNED} select id, cluster_id, round(score, 6) as score from placed",
        "assign_l2": f"""with {_VEC}, {_means("vec", "label", "cent", False)},
            every as (select s.id, c.cluster_id, {_SQ} as score from vec s cross join cent c)
            select id, cluster_id, round(score, 6) as score from every
            qualify row_number() over (partition by id order by score, cluster_id) = 1""",
        "lloyd_2iter": f"""with {_ASSIGNED.replace("placed", "a0").replace("cent", "c0")},
            {_means("a0", "cluster_id", "c1", True)}, {_nearest_ip("vec", "c1", "a1")},
            {_means("a1", "cluster_id", "c2", True)}, {_nearest_ip("vec", "c2", "a2")}
            select id, cluster_id, round(score, 6) as score from a2""",
        "assign_and_sort": f"""with {_ASSIGNED}, {_ranked("placed", "cluster_id", "dist desc, id")}
            select cluster_id, rank, id, round(dist, 6) as dist from ranked""",
        "rank_within_cluster": f"""with {_LABEL_DIST}, {_ranked("placed", "cluster_id", "dist, id")}
            select cluster_id, rank, id, round(dist, 6) as dist from ranked""",
        "cluster_slice": f"""with {_LABEL_RANKED}
            select cluster_id, rank, id from ranked where cluster_id between 2 and 5""",
        "gather_vectors": f"""with {_LABEL_RANKED}
            select cluster_id, rank, id, round(list_sum(v), 6) as total from ranked""",
        "cluster_sizes": """select label as cluster_id, count(*) as cluster_size
            from embeddings group by 1""",
        "duplicate_ids": """select lang as cluster_id, md5(text) as id, count(*) as n_rows
            from documents group by 1, 2 having count(*) > 1""",
        "resume_pending": """select label as cluster_id, vec_id as id from embeddings
            where label not in (select label from embeddings group by label
              having count(*) > (select count(*) / 10::double from embeddings))""",
        "pairs_within_cluster": f"""with {_VEC}
            select a.label as cluster_id, count(*) as n_pairs, round(sum(s), 6) as sum_sim,
              round(sum(s * s), 6) as sum_sq_sim, round(max(s), 6) as max_sim,
              round(min(s), 6) as min_sim
            from (select a.label, list_inner_product(a.v, b.v) as s
                  from vec a join vec b on a.label = b.label and a.id < b.id) a group by 1""",
        "max_prior_sim": f"with {_LANG_PRIOR} select lang, id, round(max_sim, 6) as max_sim from prior",
        "teammate": f"""with {_LABEL_PRIOR}
            select cluster_id, id, round(max_sim, 6) as max_sim, mate_id, mate_rank from prior""",
        "flag_long": f"""with {_LANG_PRIOR}
            select lang, id, eps, max_sim > 1 - eps as is_dup
            from prior cross join {_eps_rows(DOC_EPS)}""",
        "flag_wide": f"""with {_LABEL_PRIOR}
            select cluster_id, id, round(max_sim, 6) as max_sim, mate_id,
            {", ".join(f'max_sim > 1 - {e!r}::double as "eps={eps_name(e)}"' for e in WIDE_EPS)}
            from prior""",
        "singletons": f"""with {_DOC}, sized as (
              select *, n_chars as cluster_id, count(*) over (partition by n_chars) as n from doc),
            {_prior("sized", ["cluster_id"], "id")}
            select cluster_id, id, max_sim, max_sim > 1 - 0.07::double as is_dup
            from prior where n = 1""",
        "flag_chunked": f"""with {_DOC}, {_ranked("doc", "lang", "id")},
            sized as (select *, count(*) over (partition by lang) as n from ranked),
            chunked as (select *, {_chunk("rank", "n", DOC_CHUNK_LIMIT)}::int as chunk from sized),
            {_prior("chunked", ["lang", "chunk"], "rank")}
            select lang, chunk, id, eps, max_sim > 1 - eps as is_dup
            from prior cross join {_eps_rows(DOC_EPS)}""",
        "prune_given_centroids": f"""with {_DOC},
            coded as (select *, ascii(lang) * 256 + ascii(substr(lang, 2)) as code from doc),
            {_means("coded", "code", "cent", True)},
            {_nearest_ip("doc", "cent", "placed")},
            {_ranked("placed", "cluster_id", "dist desc, id")},
            {_prior("ranked", ["cluster_id"], "rank")}
            select eps, count(*) filter (not max_sim > 1 - eps) as n_kept,
              round(100 * count(*) filter (not max_sim > 1 - eps) / count(*)::double, 6)
                as retained_pct
            from prior cross join {_eps_rows(DOC_EPS)} group by eps""",
        "prune_table_rows": f"""with {_ASSIGNED}, {_ranked("placed", "cluster_id", "dist desc, id")},
            {_prior("ranked", ["cluster_id"], "rank")}
            select cluster_id, id, rank, round(max_sim, 6) as max_sim, mate_id, mate_rank
            from prior""",
        "avg_sim_to_others": f"""with {_VEC}, {_OTHERS}
            select cluster_id, id, round(sum(s) / count(*), 6) as avg_sim_to_others
            from others group by 1, 2""",
        "minmax_sim": f"""with {_VEC}, {_OTHERS}
            select cluster_id, id, round(greatest(max(s), 0), 6) as max_pair_w_sim,
              round(least(min(s), 0), 6) as min_pair_w_sim
            from others group by 1, 2""",
        "group_size": f"""with {_DOC}, near as (
              select a.id, round(list_inner_product(a.v, b.v), {SIM_DECIMALS}) as s
              from doc a join doc b on a.lang = b.lang and a.id <> b.id)
            select lang, doc.id,
            {", ".join(f"1 + count(*) filter (s > 1 - {e}::double) as group_size_{i}"
                       for i, e in enumerate((0.01, 0.03, 0.07)))}
            from doc left join near on near.id = doc.id group by 1, 2""",
        "std_pair_sim": f"""with {_DOC}, near as (
              select a.lang, list_inner_product(a.v, b.v) as s
              from doc a join doc b on a.lang = b.lang and a.id <> b.id),
            sums as (select lang, sum(s) as s, sum(s * s) as q from near group by 1),
            sizes as (select lang, count(*) as n from doc group by 1)
            select lang, n as cluster_size,
              round({_std("n::double", "s", "q")}, 6) as std_pair_w_sim
            from sizes left join sums using (lang)""",
        "sim_to_centroid": f"""with {_LABEL_DIST}
            select cluster_id, count(*) as cluster_size, round(avg(1 - dist), 6) as avg_sim_to_cent,
              round(stddev_pop(1 - dist), 6) as std_sim_to_cent
            from placed group by 1""",
        "eps_cluster_stats": f"""with {_LANG_PRIOR}
            select lang, eps, count(*) filter (max_sim > 1 - eps) as num_duplicates,
              round(100 * count(*) filter (max_sim > 1 - eps) / count(*)::double, 6)
                as duplicates_ratio
            from prior cross join {_eps_rows(DOC_EPS)} group by 1, 2""",
        "cluster_stats": f"""with {_LABEL_DIST},
            cents as (select cluster_id, count(*) as n, avg(1 - dist) as a, stddev_pop(1 - dist) as d
              from placed group by 1),
            sums as (select a.cluster_id, sum(s) as s, sum(s * s) as q, max(s) as hi, min(s) as lo
              from (select a.cluster_id, list_inner_product(a.v, b.v) as s from placed a
                    join placed b on a.cluster_id = b.cluster_id and a.id <> b.id) a group by 1)
            select cluster_id, n as cluster_size, round(a, 6) as avg_sim_to_cent,
              round(d, 6) as std_sim_to_cent,
              round({_std("n::double", "s", "q")}, 6) as std_pair_w_sim,
              round(hi, 6) as max_sim, round(lo, 6) as min_sim
            from cents join sums using (cluster_id) where n > 1""",
        "cluster_stats_chunked": f"""with {_LABEL_RANKED},
            sized as (select *, count(*) over (partition by cluster_id) as n from ranked),
            chunked as (select *, {_chunk("rank", "n", CHUNK_LIMIT // 10)}::int as chunk from sized),
            parts as (select cluster_id, chunk, count(*) as n from chunked group by 1, 2),
            sums as (select a.cluster_id, a.chunk, sum(s) as s, sum(s * s) as q, max(s) as hi,
                min(s) as lo
              from (select a.cluster_id, a.chunk, list_inner_product(a.v, b.v) as s from chunked a
                    join chunked b on a.cluster_id = b.cluster_id and a.chunk = b.chunk
                      and a.id <> b.id) a group by 1, 2)
            select cluster_id, sum(n)::bigint as cluster_size,
              round(avg({_std("n::double", "s", "q")}), 6) as std_pair_w_sim,
              round(max(hi), 6) as max_sim, round(min(lo), 6) as min_sim
            from parts left join sums using (cluster_id, chunk) group by 1
            having sum(n) > 1""",
        "kept_ids": f"""with {_LANG_PRIOR}
            select eps, id from prior cross join {_eps_rows(DOC_EPS)} where not max_sim > 1 - eps""",
        "removed_ids": f"""with {_LANG_PRIOR}
            select eps, id from prior cross join {_eps_rows(DOC_EPS)} where max_sim > 1 - eps""",
        "retained_ratio": f"""with {_LANG_PRIOR}
            select eps, count(*) filter (not max_sim > 1 - eps) as n_kept,
              round(100 * count(*) filter (not max_sim > 1 - eps) / count(*)::double, 6)
                as retained_pct
            from prior cross join {_eps_rows(DOC_EPS)} group by eps""",
        "output_label": f"""with {_LANG_PRIOR}
            select eps, printf('%.2f', (100 * count(*) filter (not max_sim > 1 - eps)
              / count(*)::double) / 100) as ratio
            from prior cross join {_eps_rows(DOC_EPS)} group by eps""",
        "filter_corpus": f"""with {_LANG_PRIOR}
            select doc_id, text from documents
            where doc_id in (select id from prior where not max_sim > 1 - 0.05::double)""",
        "filter_corpus_multi": f"""with {_LANG_PRIOR}
            select eps, doc_id, md5(text) as text_md5
            from documents join prior on id = doc_id cross join {_eps_rows(DOC_EPS)}
            where not max_sim > 1 - eps""",
    }
    for name, same in {
        "flag_by_bounds": "flag_long",
        "run_given_centroids": "prune_table_rows",
        "assignment_round_trip": "dist_spherical",
        "prune_table_round_trip": "flag_wide",
        "stats_round_trip": "avg_sim_to_others",
        "kept_round_trip": "kept_ids",
        "retained_round_trip": "retained_ratio",
    }.items():
        sql[name] = sql[same]
    bad = "(id % 7 = 3 or id % 11 = 5 or id % 13 = 6)"
    sql["sorted_clusters_round_trip"] = f"""with {_LABEL_RANKED}
        select cluster_id, rank, id, round(dist, 6) as dist from ranked"""
    sql["prune_invalid_vectors"] = f"""with {_VEC}, {_means("vec", "label", "cent", True)},
        fit as (select * from vec where not {bad}), {_nearest_ip("fit", "cent", "placed")},
        {_ranked("placed", "cluster_id", "dist desc, id")},
        {_prior("ranked", ["cluster_id"], "rank")}
        select cluster_id, id, rank, round(max_sim, 6) as max_sim, mate_id from prior
        union all select null, id, null, 0.0::double, null from vec where {bad}"""
    sql["kmeans_invariants"] = f"""with {_VEC}
        select count(*) as n_rows, round(sum(list_sum(v)), 4) as total, 10::bigint as n_clusters,
          10::bigint as unit_centroids, true as not_above_start from vec"""
    sql["kmeans_two_level"] = """select count(*) as n_rows, 24::bigint as n_clusters,
        24::bigint as unit_centroids, true as not_above_coarse from embeddings"""
    sql["last_token_pool_nested"] = f"""with {_VEC}
        select id, (i - 1)::int as dim, round(x, 6) as value from
        (select id, unnest(p) as x, generate_subscripts(p, 1) as i
         from (select id, v[{DIM - DIM // TOKENS + 1}:{DIM}] as p from vec))"""
    sql["saved_model_reused"] = """select count(*) as n_rows, count(*) as n_same
        from embeddings"""
    cosine = (
        "1 - list_inner_product(v, c) / "
        "(sqrt(list_inner_product(v, v)) * sqrt(list_inner_product(c, c)))"
    )
    sql["metric_options"] = f"""with {_ASSIGNED}, {_means("vec", "label", "plain", False)},
        every as (select s.id, s.v, c.c, {_SQ} as sq, c.cluster_id from vec s cross join plain c),
        near as (select * from every
          qualify row_number() over (partition by id order by sq, cluster_id) = 1),
        options as (select * from (values ('cosine', true), ('cosine', false), ('l2', true),
          ('l2', false), ('dot', true), ('dot', false)) o(metric, spherical))
        select metric, spherical, (select count(*) from vec) as n_rows,
          case when metric = 'cosine' and spherical
                 then (select round(sum(dist), 4) from placed)
               when metric = 'cosine' then (select round(sum({cosine}), 4) from near)
               when metric = 'l2' and not spherical then (select round(sum(sq), 4) from near)
          end as cost
        from options"""
    sql["run_with_statistics"] = f"""with {_ASSIGNED},
        {_ranked("placed", "cluster_id", "dist desc, id")},
        {_prior("ranked", ["cluster_id"], "rank")},
        dups as (select cluster_id, count(*) filter (max_sim > 1 - {WIDE_EPS[-1]!r}::double)
            as num_duplicates from prior group by 1),
        cents as (select cluster_id, count(*) as n, avg(1 - dist) as a, stddev_pop(1 - dist) as d
          from placed group by 1),
        sums as (select a.cluster_id, sum(s) as s, sum(s * s) as q, max(s) as hi, min(s) as lo
          from (select a.cluster_id, list_inner_product(a.v, b.v) as s from placed a
                join placed b on a.cluster_id = b.cluster_id and a.id <> b.id) a group by 1)
        select cluster_id, n as cluster_size, num_duplicates, round(a, 6) as avg_sim_to_cent,
          round(d, 6) as std_sim_to_cent,
          round({_std("n::double", "s", "q")}, 6) as std_pair_w_sim,
          round(hi, 6) as max_sim, round(lo, 6) as min_sim
        from cents join sums using (cluster_id) join dups using (cluster_id) where n > 1"""
    sql["pruned_corpus_lines"] = f"""with {_LANG_PRIOR}
        select eps, row_number() over (partition by eps order by doc_id) - 1 as line_no, doc_id
        from documents join prior on id = doc_id cross join {_eps_rows(LINE_EPS)}
        where not max_sim > 1 - eps"""
    for rule, order in {
        "hard": "dist desc, id",
        "easy": "dist, id desc",
        "random": "md5('1234:' || id), id",
    }.items():
        sql[f"order_{rule}"] = (
            f"with {_LABEL_DIST}, {_ranked('placed', 'cluster_id', order)} "
            "select cluster_id, rank, id from ranked"
        )
    return sql
