"""DuckDB SQL building blocks for the correctness oracle.

Each named CTE mirrors one native table or operator, written the plain
(literal, unscaled) way -- e.g. the all-pairs Jaccard is the reference's
cross join.  ``sql(deps, body)`` prepends the needed CTEs in dependency order.
"""

from __future__ import annotations

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "users": ((), """select c_custkey new_id, c_custkey ids, c_acctbal views,
        cast(c_nationkey as bigint) as "days", c_mktsegment = 'BUILDING' partner,
        c_acctbal < 0 mature from customer"""),
    "user_games": ((), """select distinct o_custkey new_id, cast(p_size as bigint) game
        from orders join lineitem on o_orderkey = l_orderkey join part on l_partkey = p_partkey"""),
    "follows": ((), """select o_custkey src, l_partkey dst from orders
        join lineitem on o_orderkey = l_orderkey where l_returnflag = 'R'"""),
    "ev": ((), """select event_id, user_id,
        cast(json_extract_string(props, '$.k') as bigint) target_user_id,
        case event_type when 'signup' then 'follow' when 'view' then 'watch'
          when 'click' then 'game_play' when 'error' then 'unfollow' else event_type end action,
        event_type, ts from events"""),
    "wev": (("ev",), """select *, cast(case action when 'follow' then 3.0 when 'watch' then 2.0
        when 'game_play' then 1.5 when 'unfollow' then -1.0 else 1.0 end as double) weight from ev"""),
    "inter": (("wev",), """select user_id, target_user_id, sum(weight) interaction_score
        from wev group by user_id, target_user_id"""),
    "inter_follow": (("wev",), """select user_id, target_user_id, sum(weight) interaction_score
        from wev where event_type in ('signup', 'error') group by user_id, target_user_id"""),
    "sets": (("inter",), """select user_id, list(distinct target_user_id) targets
        from inter where interaction_score > 0 group by user_id"""),
    "sets_follow": (("inter_follow",), """select user_id, list(distinct target_user_id) targets
        from inter_follow where interaction_score > 0 group by user_id"""),
    "jac": (("sets",), """select a.user_id user_a, b.user_id user_b,
        nullif(len(list_intersect(a.targets, b.targets)), 0)
          / nullif(len(list_distinct(list_concat(a.targets, b.targets))), 0) jaccard_score
        from sets a cross join sets b where a.user_id < b.user_id"""),
    "jac_follow": (("sets_follow",), """select a.user_id user_a, b.user_id user_b,
        nullif(len(list_intersect(a.targets, b.targets)), 0)
          / nullif(len(list_distinct(list_concat(a.targets, b.targets))), 0) jaccard_score
        from sets_follow a cross join sets_follow b where a.user_id < b.user_id"""),
    "strong": (("jac",), """select user_a, user_b, jaccard_score from jac where jaccard_score > 0.1"""),
    "strong_follow": (("jac_follow",), """select user_a, user_b, jaccard_score from jac_follow
        where jaccard_score > 0.1"""),
    # graph
    "vtx": (("users",), "select new_id id from users"),
    "gedges": (("follows",), "select distinct src, dst from follows"),
    "kedges": (("follows", "users"), """select distinct src, dst from follows
        where src in (select new_id from users) and dst in (select new_id from users)"""),
    "und": (("kedges",), "select src, dst from kedges union select dst, src from kedges"),
    "nbr": (("und",), """select src id, count(*) n_nbrs,
        count(*) + sum(case when src = dst then 1 else 0 end) degree from und group by src"""),
}


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in CTES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def sql(deps, body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <deps and their deps>, <extra...> <body>``."""
    parts = [f"{n} as ({CTES[n][1]})" for n in _order(deps)]
    for k, v in (extra or {}).items():
        parts.append(f"{k} as ({v})")
    return ("with " + ",\n".join(parts) + "\n" + body) if parts else body

CTES.update({
    "gsz": (("gedges",), "select src, count(*) n from gedges group by src"),
    "nsim": (("gedges", "gsz"), """select node1, node2, c / (s1.n + s2.n - c) similarity from
        (select a.src node1, b.src node2, count(*) c from gedges a join gedges b
           on a.dst = b.dst and a.src <> b.src group by a.src, b.src) p
        join gsz s1 on s1.src = p.node1 join gsz s2 on s2.src = p.node2"""),
    "nsim_top": (("nsim",), """select node1, node2, similarity from (select *, row_number() over
        (partition by node1 order by similarity desc, node2) r from nsim) where r <= 10"""),
    "fusers": (("users", "user_games"), "select * from users where new_id in (select new_id from user_games)"),
    "base": (("fusers",), """select new_id,
        case when max(views) over () > min(views) over ()
             then (views - min(views) over ()) / (max(views) over () - min(views) over ()) else 0.0 end views,
        case when max(days) over () > min(days) over ()
             then (days - min(days) over ()) / (max(days) over () - min(days) over ()) else 0.0 end as "days",
        cast(partner as integer) partner, cast(mature as integer) mature from fusers"""),
    "vocab": (("user_games",), """select game, cast(row_number() over (order by game) - 1 as integer) game_idx
        from (select distinct game from user_games)"""),
    "hot": (("user_games", "vocab"), "select new_id, game, game_idx from user_games join vocab using (game)"),
})


def h(expr: str) -> str:
    """DuckDB form of ``hash_order``: first 32 bits of md5(text)."""
    return f"('0x' || substr(md5({expr}), 1, 8))::BIGINT"


CTES.update({
    "split": (("follows",), f"""select src, dst, (n >= 2 and rn <= (n + 4) // 5) is_test from
        (select src, dst, count(*) over (partition by src) n,
                row_number() over (partition by src order by hv, dst) rn
         from (select src, dst, {h("src || '|' || dst || '|42'")} hv from follows))"""),
    "uidx": (("users",), "select new_id, row_number() over (order by new_id) - 1 pos from users"),
    "nusers": (("users",), "select count(*) c from users"),
    "kfollows": (("follows", "users"), """select src, dst from follows
        where src in (select new_id from users) and dst in (select new_id from users)"""),
    "pos": (("kfollows",), f"""select src, dst from kfollows
        order by {h("src || '|' || dst || '|42'")}, src, dst limit 5000"""),
    "neg": (("uidx", "nusers", "follows"), f"""select draw, src, dst from
        (select draw, a.new_id src, b.new_id dst from
          (select i draw, {h("i || '|u|42'")} % (select c from nusers) pu,
                  {h("i || '|v|42'")} % (select c from nusers) pv from range(0, 100000) t(i)) d
          join uidx a on a.pos = d.pu join uidx b on b.pos = d.pv
          where a.new_id <> b.new_id
            and not exists (select 1 from follows f where f.src = a.new_id and f.dst = b.new_id))
        order by draw limit 5000"""),
    "dataset": (("pos", "neg"), """select src u, dst v, 1 label from pos
        union all select src, dst, 0 from neg"""),
    # the smallest prime from the number of users on
    "prime": (("nusers",), """select min(p) p from (select unnest(range(greatest(c, 2), 2 * c + 3)) p from nusers)
        where p not in (select a * b from (select unnest(range(2, c + 2)) a from nusers),
                                          (select unnest(range(2, c + 2)) b from nusers))"""),
    "cands": (("uidx", "nusers", "prime"), f"""select user_id, new_id candidate, j from
        (select user_id, pos, j, row_number() over (partition by user_id order by j) rk from
          (select user_id, j, (start + j * step) % p pos from
            (select new_id user_id, p, {h("new_id || '|start|42'")} % p start,
                    {h("new_id || '|step|42'")} % (p - 1) + 1 step,
                    unnest(range(0, least(p, 200 + p - c))) j
             from users, nusers, prime))
         where pos < (select c from nusers))
        join uidx using (pos) where rk <= 200"""),
    # pair features over the feature-matrix users' graph
    "fkedges": (("follows", "fusers"), """select distinct src, dst from follows
        where src in (select new_id from fusers) and dst in (select new_id from fusers)"""),
    "fund": (("fkedges",), "select src, dst from fkedges union select dst, src from fkedges"),
    "fnbr": (("fund",), """select src id, count(*) n_nbrs,
        count(*) + sum(case when src = dst then 1 else 0 end) degree from fund group by src"""),
    "fvec": (("base", "hot"), """select b.new_id, b.views, b.days, b.partner, b.mature,
        list(h.game_idx) games,
        sqrt(b.views * b.views + b.days * b.days + b.partner + b.mature + count(*)) nrm
        from hot h join base b using (new_id) group by b.new_id, b.views, b.days, b.partner, b.mature"""),
})


def pair_topology_sql(pairs: str) -> str:
    """SELECT of u, v, common_neighbors, jaccard, adamic_adar for the distinct pairs of CTE ``pairs``."""
    return f"""select p.u, p.v, coalesce(c.cn, 0) common_neighbors,
        case when coalesce(nu.n_nbrs, 0) + coalesce(nv.n_nbrs, 0) - coalesce(c.cn, 0) > 0
             then coalesce(c.cn, 0) / (coalesce(nu.n_nbrs, 0) + coalesce(nv.n_nbrs, 0) - coalesce(c.cn, 0))
             else 0.0 end jaccard,
        coalesce(c.aa, 0.0) adamic_adar
      from (select distinct u, v from {pairs}) p
      left join (select p2.u, p2.v, count(*) cn,
                   sum(case when d.degree > 1 then 1.0 / ln(d.degree) else 0.0 end) aa
                 from (select distinct u, v from {pairs}) p2
                 join fund a on a.src = p2.u join fund b on b.src = p2.v and b.dst = a.dst
                 left join fnbr d on d.id = a.dst group by p2.u, p2.v) c on c.u = p.u and c.v = p.v
      left join fnbr nu on nu.id = p.u left join fnbr nv on nv.id = p.v"""

CTES.update({
    "fcos": (("fvec",), """select a.new_id u, b.new_id v, case when a.nrm * b.nrm > 0 then
        (a.views * b.views + a.days * b.days + a.partner * b.partner + a.mature * b.mature
         + len(list_intersect(a.games, b.games))) / (a.nrm * b.nrm) else 0.0 end c
        from fvec a cross join fvec b"""),
    "pvec": (("base", "user_games"), """select b.new_id, b.views, b.days, b.partner, b.mature, l.games,
        sqrt(b.views * b.views + b.days * b.days + b.partner + b.mature
             + list_dot_product(l.games, l.games)) nrm
        from (select new_id, list(cast(game as double) order by game) games from user_games group by new_id) l
        join base b using (new_id)"""),
    "pcos": (("pvec",), """select a.new_id u, b.new_id v,
        (a.views * b.views + a.days * b.days + a.partner * b.partner + a.mature * b.mature
         + list_dot_product(a.games[1:least(len(a.games), len(b.games))],
                            b.games[1:least(len(a.games), len(b.games))])) / (a.nrm * b.nrm) c
        from pvec a cross join pvec b"""),
    "trn": (("split",), "select distinct src, dst from split where not is_test"),
    "amat": (("split", "fusers"), """select src i, dst j, count(*) a from split where not is_test
        and src in (select new_id from fusers) and dst in (select new_id from fusers) group by src, dst"""),
    "cfol": (("amat",), "select x.i u, y.i v, sum(x.a * y.a) s from amat x join amat y on x.j = y.j group by x.i, y.i"),
    "allp": (("fcos", "cfol"), "select f.u, f.v, f.c, coalesce(cf.s, 0) s from fcos f left join cfol cf using (u, v)"),
    "umm": (("allp",), """select u, min(case when u <> v then c end) cmin, max(case when u <> v then c end) cmax,
        min(s) smin, max(s) smax from allp group by u"""),
})


def hybrid_sql(alpha_list: str, users_filter: str = "") -> str:
    """Blended stand-in scores per (alpha, u, v) after exclusion, ranked."""
    return f"""select alpha, u, v, score, row_number() over (partition by alpha, u order by score desc, v) rk from
        (select a.alpha, p.u, p.v, a.alpha * (p.c - m.cmin) / (m.cmax - m.cmin + 1e-9)
                + (1 - a.alpha) * (p.s - m.smin) / (m.smax - m.smin + 1e-9) score
         from allp p join umm m using (u) cross join (select unnest(cast({alpha_list} as double[])) alpha) a
         where p.u <> p.v {users_filter}
           and not exists (select 1 from trn t where t.src = p.u and t.dst = p.v))"""
