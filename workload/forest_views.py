"""Check views that grow and walk the isolation forest again, level by level."""

from __future__ import annotations

from bazaarlens.fixed_values import FEATURE_COLUMNS, RANDOM_STATE
from bazaarlens.plans.isolation import DIGITS, EULER_GAMMA, PRIME, SAMPLE, TREES
from workload.registry import stored_view

LEVELS = 8  # of a tree over a full sample


def _number(text: str) -> str:
    return f"cast('0x' || substr(md5({text}), 1, {DIGITS}) as bigint)"


def _share(what: str) -> str:
    return f"{_number(f"'{what}:{RANDOM_STATE}:' || tree || ':' || node")} / {float(16**DIGITS)}"


stored_view(
    "forest_points",
    f"""
select category_id, snapshot_date_key, category_id || '|' || snapshot_date_key as row_key,
    [{", ".join(f"cast(coalesce({c}, 0) as double)" for c in FEATURE_COLUMNS)}] as x
from features
""",
)
stored_view(
    "forest_rows0",
    f"""
select tree, x, 1 as node from (
    select tree, x, row_number() over (partition by tree order by
        ((1 + {_number(f"'a:{RANDOM_STATE}:' || tree")} % {PRIME - 1}) * ({_number("row_key")} % {PRIME})
            + {_number(f"'b:{RANDOM_STATE}:' || tree")} % {PRIME}) % {PRIME}, row_key) as nth
    from forest_points cross join (select unnest(range({TREES})) as tree) trees
) drawn where nth <= {SAMPLE}
""",
)
for _level in range(LEVELS + 1):
    _lows = ", ".join(f"min(x[{i}])" for i in range(1, len(FEATURE_COLUMNS) + 1))
    stored_view(
        f"forest_cut{_level}",
        f"""
select tree, node, n, feature, low[feature] + {_share("cut")} * (high[feature] - low[feature]) as cut from (
    select *, case when n > 1 and {_level} < (select ceil(log2(greatest(least({SAMPLE}, count(*)), 2))) from forest_points)
        then varied[1 + cast(floor({_share("feature")} * len(varied)) as bigint)] end as feature
    from (
        select *, list_filter(range(1, {len(FEATURE_COLUMNS) + 1}), lambda i: high[i] > low[i]) as varied from (
            select tree, node, count(*) as n, [{_lows}] as low, [{_lows.replace("min", "max")}] as high
            from forest_rows{_level} group by tree, node
        ) extents
    ) ranges
) chosen
""",
    )
    stored_view(
        f"forest_rows{_level + 1}",
        f"""
select r.tree, r.x, 2 * r.node + case when r.x[c.feature] > c.cut then 1 else 0 end as node
from forest_rows{_level} r join forest_cut{_level} c on r.tree = c.tree and r.node = c.node
where c.feature is not null
""",
    )
stored_view(
    "forest_nodes",
    " union all ".join(
        f"""select tree, node, feature, cut, {_level} + case when n <= 1 then 0 when n = 2 then 1
            else 2 * (ln(n - 1) + {EULER_GAMMA}) - 2 * (n - 1) / n end as path from forest_cut{_level}"""
        for _level in range(LEVELS + 1)
    ),
)
stored_view(
    "forest_scores",
    f"""
select p.category_id, p.snapshot_date_key, pow(2, -avg(w.path) / max(u.usual)) as isolation_score from (
    with recursive walk as (
        select row_key, x, n.* from forest_points join forest_nodes n on n.node = 1
        union all
        select w.row_key, w.x, n.* from walk w join forest_nodes n
            on n.tree = w.tree and n.node = 2 * w.node + case when w.x[w.feature] > w.cut then 1 else 0 end
        where w.feature is not null
    ) select row_key, path from walk where feature is null
) w join forest_points p on p.row_key = w.row_key cross join (
    select case when n <= 1 then 1e-12 when n = 2 then 1 else 2 * (ln(n - 1) + {EULER_GAMMA}) - 2 * (n - 1) / n end as usual
    from (select cast(least({SAMPLE}, count(*)) as double) as n from forest_points) counted
) u
group by p.category_id, p.snapshot_date_key
""",
)
