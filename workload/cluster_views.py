"""Check views that run every k-means fit again from the same starts."""

from __future__ import annotations

from bazaarlens.fixed_values import CLUSTER_RESTARTS, FEATURE_COLUMNS, MAX_CLUSTERS, RANDOM_STATE
from bazaarlens.plans.clusters import FINE, GRID, STARTS
from bazaarlens.plans.isolation import PRIME
from workload.check_views import rnd
from workload.forest_views import _number
from workload.registry import stored_view

STEPS = 60  # more than any fit needs on the tables that are checked
WIDTH = len(FEATURE_COLUMNS)


def _distance(x: str, centre: str) -> str:
    return " + ".join(f"pow({x}[{i}] - {centre}[{i}], 2)" for i in range(1, WIDTH + 1))


_VALUES = ", ".join(
    f"round_even(case when (select stddev_pop({c}) from scores) > 0 then (coalesce({c}, 0) - (select avg({c}) from scores)) / (select stddev_pop({c}) from scores) else 0 end * {GRID}, 0)"
    for c in FEATURE_COLUMNS
)
stored_view("cluster_points", f"select category_id, category_id || '|' || snapshot_date_key as row_key, [{_VALUES}] as x from scores")
stored_view(
    "cluster_starts",
    f"""
select restart, x, row_number() over (partition by restart order by nth) - 1 as cluster from (
    select restart, x, min(nth) as nth from (
        select restart, x, row_number() over (partition by restart order by
            ((1 + {_number(f"'a:{RANDOM_STATE}:' || restart")} % {PRIME - 1}) * ({_number("row_key")} % {PRIME})
                + {_number(f"'b:{RANDOM_STATE}:' || restart")} % {PRIME}) % {PRIME}, row_key) as nth
        from cluster_points cross join (select unnest(range({CLUSTER_RESTARTS})) as restart) restarts
    ) drawn where nth <= {STARTS} group by restart, x
) firsts
""",
)
_MEANS = ", ".join(f"sum(x[{i}]) filter (where own) / count(*) filter (where own)" for i in range(1, WIDTH + 1))
stored_view(
    "cluster_centres",
    f"""
select k, restart, cluster, centre from (
    with recursive lloyd as (
        select 0 as step, k, restart, cluster, x as centre
        from cluster_starts join (select unnest(range(2, 1 + (select least({MAX_CLUSTERS}, count(*) - 1) from cluster_points))) as k) ks on cluster < k
        union all
        select step + 1, k, restart, cluster, case when count(*) filter (where own) > 0 then [{_MEANS}] else any_value(centre) end
        from (
            select l.*, p.x, row_number() over (partition by p.row_key, l.k, l.restart order by {_distance("p.x", "l.centre")}, l.cluster) = 1 as own
            from lloyd l cross join cluster_points p where l.step < {STEPS}
        ) near group by step, k, restart, cluster
    ) select * from lloyd where step = {STEPS}
) ended
""",
)
stored_view(
    "cluster_members",
    f"""
select * from (
    select c.k, c.restart, c.cluster, p.category_id, p.row_key, p.x, {_distance("p.x", "c.centre")} as d,
        row_number() over (partition by p.row_key, c.k, c.restart order by {_distance("p.x", "c.centre")}, c.cluster) as nth
    from cluster_centres c cross join cluster_points p
) near where nth = 1
""",
)
stored_view(
    "cluster_fits",
    f"""
select m.* from cluster_members m join (
    select k, restart, row_number() over (partition by k order by round(sum(d) / {float(GRID) ** 2}, 6), restart) as nth
    from cluster_members group by k, restart
) f on f.k = m.k and f.restart = m.restart where f.nth = 1
""",
)
stored_view(
    "cluster_candidates",
    f"""
select k, sum(round_even(s * {FINE}, 0)) / {FINE} / count(*) as silhouette_score from (
    select k, row_key, case when own_size > 1 and outside is not null and greatest(inside, outside) > 0
        then (outside - inside) / greatest(inside, outside) else 0 end as s
    from (
        select a.k, a.row_key, count(*) filter (where b.cluster = a.cluster) as own_size,
            sum({_distance("a.x", "b.x")}) filter (where b.cluster = a.cluster) / greatest(count(*) filter (where b.cluster = a.cluster) - 1, 1) as inside,
            min(o.m) as outside
        from cluster_fits a join cluster_fits b on a.k = b.k
        left join (
            select p.k, p.row_key, q.cluster, avg({_distance("p.x", "q.x")}) as m
            from cluster_fits p join cluster_fits q on p.k = q.k and p.cluster <> q.cluster group by p.k, p.row_key, q.cluster
        ) o on o.k = a.k and o.row_key = a.row_key and o.cluster = b.cluster
        group by a.k, a.row_key, a.cluster
    ) means
) silhouettes group by k
""",
)
stored_view(
    "clusters",
    f"""
select category_id, cast(cluster as int) as cluster_id, 'cluster_' || cluster as cluster_label, {rnd(f"sqrt(d) / {float(GRID)}", 4)} as cluster_distance
from cluster_fits where k = (select k from cluster_candidates order by silhouette_score desc, k limit 1)
""",
)
