"""Joins J1-J15, hierarchy H1."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from supplyloom.functions.dates import period_of
from supplyloom.operators import intervals, joins
from supplyloom.operators.hierarchy import interval_labels, join_below, top_level
from supplyloom.operators.joins import Lookup
from supplyloom.operators.membership import reduce_children
from supplyloom.operators.scope import current_fy_scope
from supplyloom.queries.projections import AS_OF as SCOPE_DAY
from supplyloom.queries.projections import SCOPE_SQL
from supplyloom.queries.registry import SQL, query
from supplyloom.queries.roles import with_roles
from supplyloom.session import staged


@query(
    "j1_star_lookups",
    with_roles(
        "request sq_customer country dc sq_supplier status",
        """SELECT r.id, d.name AS center, c.name AS customer, cc.title AS customer_country, rc.title AS requester_country,
        s.ifa, sc.title AS supplier_country, st.name AS status FROM r_request r LEFT JOIN r_dc d ON d.id = r.delivery_center_id
        LEFT JOIN r_sq_customer c ON c.id = r.customer_id LEFT JOIN r_country cc ON cc.id = c.country_id
        LEFT JOIN r_country rc ON rc.id = r.country_id LEFT JOIN r_sq_supplier s ON s.id = r.supplier_id
        LEFT JOIN r_country sc ON sc.id = s.country_id LEFT JOIN r_status st ON st.id = r.status_id""",
    ),
)
def star_lookups(t):
    return joins.denormalize(
        t["request"].select("id", "delivery_center_id", "customer_id", "country_id", "supplier_id", "status_id"),
        [
            Lookup(t["dc"], "delivery_center_id", {"center": "name"}),
            Lookup(t["sq_customer"], "customer_id", {"customer": "name", "cu_country": "country_id"}),
            Lookup(t["country"], "cu_country", {"customer_country": "title"}),
            Lookup(t["country"], "country_id", {"requester_country": "title"}),
            Lookup(t["sq_supplier"], "supplier_id", {"ifa": "ifa", "sup_country": "country_id"}),
            Lookup(t["country"], "sup_country", {"supplier_country": "title"}),
            Lookup(t["status"], "status_id", {"status": "name"}),
        ],
    ).select("id", "center", "customer", "customer_country", "requester_country", "ifa", "supplier_country", "status")


PIVOT_SQL = """SELECT r.id, a.is_already_done AS coc_old_is_already_done, a.finished::VARCHAR AS coc_old_finished,
        b.is_already_done AS crsa_is_already_done, b.finished::VARCHAR AS crsa_finished,
        c.is_already_done AS sc_is_already_done, c.finished::VARCHAR AS sc_finished,
        d.is_already_done AS cs_is_already_done, d.finished::VARCHAR AS cs_finished FROM r_request r
        LEFT JOIN r_qualification a ON a.qualification_process_id = r.qualification_process_id AND a.module_id = 1
        LEFT JOIN r_qualification b ON b.qualification_process_id = r.qualification_process_id AND b.module_id = 4
        LEFT JOIN r_qualification c ON c.qualification_process_id = r.qualification_process_id AND c.module_id = 5
        LEFT JOIN r_qualification d ON d.qualification_process_id = r.qualification_process_id AND d.module_id = 9"""


def _pivot(t, unique):
    from supplyloom.functions.labels import MODULES

    requests = t["request"].select("id", "qualification_process_id")
    return joins.pivot_children(
        requests, t["qualification"], "qualification_process_id", "module_id", MODULES, ["is_already_done", "finished"], unique
    ).drop("qualification_process_id")


@query("j2_j3_pivot_children", with_roles("request qualification", PIVOT_SQL))
def pivot_children(t):
    return _pivot(t, unique=False)


@query("j2_pivot_children_one_pass", with_roles("request qualification", PIVOT_SQL))
def pivot_children_one_pass(t):
    return _pivot(t, unique=True)


@query(
    "j3_join_with_condition",
    with_roles(
        "request global_customer",
        """SELECT r.id, g.customer_id AS global_id FROM r_request r LEFT JOIN r_global_customer g
        ON g.customer_id = r.customer_id AND g.is_global_customer = 1""",
    ),
)
def join_with_condition(t):
    look = Lookup(
        t["global_customer"], "customer_id", {"global_id": "customer_id"}, pk="customer_id", on=F.col("is_global_customer") == 1
    )
    return joins.denormalize(t["request"].select("id", "customer_id"), [look]).select("id", "global_id")


@query(
    "j1_children_of_scope",
    with_roles(
        "request request_module escalation contact",
        f"""SELECT r.id, coalesce(m.n, 0) AS n_modules, coalesce(e.n, 0) AS n_escalations, coalesce(c.n, 0) AS n_contacts
        FROM r_request r LEFT JOIN (SELECT request_id, count(*) AS n FROM r_request_module GROUP BY 1) m ON m.request_id = r.id
        LEFT JOIN (SELECT request_id, count(*) AS n FROM r_escalation GROUP BY 1) e ON e.request_id = r.id
        LEFT JOIN (SELECT request_id, count(*) AS n FROM r_contact GROUP BY 1) c ON c.request_id = r.id WHERE {SCOPE_SQL}""",
    ),
)
def children_of_scope(t):
    """One filter of the scoped requests reduces three child tables; the joins drop what passes it by chance."""
    requests = staged(current_fy_scope(t["request"], SCOPE_DAY).select("id"))
    children = {"request_module": "n_modules", "escalation": "n_escalations", "contact": "n_contacts"}
    reduced = reduce_children(t.pick(*children), tuple(children), requests.select(F.col("id").alias("request_id")), "request_id")
    for child, name in children.items():
        counts = reduced[child].groupBy(F.col("request_id").alias("id")).agg(F.count(F.lit(1)).alias(name))
        requests = requests.join(counts, "id", "left")
    return requests.fillna(0, list(children.values()))


@query(
    "j4_fan_out_escalations",
    with_roles(
        "request escalation",
        """SELECT r.id, e.id AS escalation_id, e.sent::VARCHAR AS sent FROM r_request r
        LEFT JOIN r_escalation e ON e.request_id = r.id""",
    ),
)
def fan_out_escalations(t):
    escalations = t["escalation"].select(F.col("request_id").alias("id"), F.col("id").alias("escalation_id"), "sent")
    return joins.fan_out(t["request"].select("id"), escalations, "id", "escalation_id")


@query(
    "j5_inner_join_roots",
    with_roles(
        "team_customer sq_customer service",
        """SELECT s.id, tc.team_id, c.name FROM r_service s JOIN r_team_customer tc ON tc.id = s.team_customer_id
        JOIN r_sq_customer c ON tc.customer_id = c.id AND c.parent_id IS NULL""",
    ),
)
def inner_join_roots(t):
    owner = t["team_customer"].select(F.col("id").alias("team_customer_id"), "team_id", "customer_id")
    roots = t["sq_customer"].filter(F.col("parent_id").isNull()).select(F.col("id").alias("customer_id"), "name")
    return t["service"].select("id", "team_customer_id").join(owner, "team_customer_id").join(roots, "customer_id").select(
        "id", "team_id", "name"
    )


@query(
    "j6_cross_periods",
    with_roles(
        "sq_customer",
        """SELECT id, period FROM r_sq_customer, (VALUES ('19980100'), ('19980200'), ('19980300')) AS p(period)
        WHERE (period >= valid_from OR valid_from IS NULL) AND (period <= valid_to OR valid_to IS NULL)""",
    ),
)
def cross_periods(t):
    from supplyloom.functions.dates import previous_periods, valid_at

    rows = joins.cross_periods(t["sq_customer"], previous_periods(date(1998, 4, 2), 3))
    return rows.filter(valid_at(F.col("period"), F.col("valid_from"), F.col("valid_to"))).select("id", "period")


@query(
    "j7_hide_invisible",
    with_roles(
        "customer_visibility",
        """SELECT o_orderkey, period FROM (SELECT o_orderkey, c_nationkey, c_custkey, strftime(o_orderdate, '%Y%m') || '00' AS period
        FROM orders JOIN customer ON c_custkey = o_custkey) t LEFT JOIN r_customer_visibility v ON v.team_id = t.c_nationkey
        AND v.customer_unit_id = t.c_custkey AND v.service_name_id = 0 AND v.valid_from IS NOT NULL AND t.period >= v.valid_from
        AND (t.period <= v.valid_to OR v.valid_to IS NULL) WHERE v.id IS NULL""",
    ),
)
def hide_invisible(t):
    rows = t["orders"].join(t["customer"], F.col("c_custkey") == F.col("o_custkey")).select(
        "o_orderkey", F.col("c_nationkey").alias("team_id"), F.lit(0).alias("service_name_id"),
        F.col("c_custkey").alias("customer_unit_id"), period_of(F.col("o_orderdate")).alias("period"),
    )
    return joins.hide_invisible(rows, t["customer_visibility"]).select("o_orderkey", "period")


@query("j7_hide_by_period", SQL["j7_hide_invisible"])
def hide_by_period(t):
    """The same rows by an equi join on key and period."""
    rows = t["orders"].join(t["customer"], F.col("c_custkey") == F.col("o_custkey")).select(
        "o_orderkey", F.col("c_nationkey").alias("team_id"), F.lit(0).alias("service_name_id"),
        F.col("c_custkey").alias("customer_unit_id"), period_of(F.col("o_orderdate")).alias("period"),
    )
    periods = [f"{m}00" for m in intervals.months_of(t["orders"], "o_orderdate")]
    return intervals.hide_by_period(rows, t["customer_visibility"], periods).select("o_orderkey", "period")


@query(
    "j8_unmatched_combinations",
    with_roles(
        "dash",
        """SELECT m.delivery_center, m.customer_name, m.n FROM (SELECT delivery_center, customer_name, count(*) AS n FROM r_dash
        GROUP BY 1, 2) m LEFT JOIN (SELECT DISTINCT delivery_center, customer_name FROM r_dash WHERE status = 'Finished') k
        ON k.delivery_center = m.delivery_center AND k.customer_name = m.customer_name WHERE k.customer_name IS NULL""",
    ),
)
def unmatched_combinations(t):
    keys = ["delivery_center", "customer_name"]
    counted = t["dash"].groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return joins.unmatched(counted, t["dash"].filter(F.col("status") == "Finished"), keys)


@query(
    "j9_not_in",
    with_roles("record po_request", "SELECT po_number, number_of_line_item, cents FROM r_record WHERE po_number NOT IN (SELECT po_number FROM r_po_request)"),
)
def not_in(t):
    return joins.not_in(t["record"], t["po_request"], "po_number").select("po_number", "number_of_line_item", "cents")


@query(
    "j9_not_in_null_aware",
    with_roles(
        "request",
        """SELECT id, agent_id FROM r_request WHERE agent_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
        AND o_totalprice > 400000)""",
    ),
)
def not_in_null_aware(t):
    listed = t["orders"].filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000))
    other = listed.select(F.col("o_custkey").alias("agent_id"))
    return joins.not_in(t["request"].select("id", "agent_id"), other, "agent_id", null_aware=True)


@query(
    "j10_exists_flag",
    with_roles(
        "request escalation",
        """SELECT id, CASE WHEN EXISTS (SELECT 1 FROM r_escalation e WHERE e.request_id = r.id AND e.solved IS NULL) THEN 'open'
        ELSE 'none' END AS escalated FROM r_request r""",
    ),
)
def exists_flag(t):
    unsolved = t["escalation"].filter(F.col("solved").isNull()).select(F.col("request_id").alias("id"))
    return joins.exists_flag(t["request"].select("id"), unsolved, "id", "escalated", "open", "none")


PRICE_SQL = """, facts AS (SELECT o_orderkey, 'Center NATION_' || CAST(c_nationkey % 7 AS VARCHAR) AS dc, c_custkey,
        CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'new' WHEN 1 THEN 'Check' WHEN 2 THEN 'Renewal' ELSE 'Hardcopy' END AS rt,
        CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 40 ELSE DATE '1998-03-10' END AS d
        FROM orders JOIN customer ON c_custkey = o_custkey),
        hits AS (SELECT o_orderkey, p.price, row_number() OVER (PARTITION BY o_orderkey ORDER BY p.valid_from DESC,
        p.valid_to DESC NULLS LAST, p.price) AS rn FROM facts LEFT JOIN r_price p ON p.delivery_center = dc
        AND p.customer_id = c_custkey AND lower(p.request_type) = lower(rt) AND strftime(d, '%Y%m%d') >= p.valid_from
        AND (p.valid_to IS NULL OR strftime(d, '%Y%m%d') <= left(p.valid_to, 6) || '31'))
        SELECT o_orderkey, CAST(price AS DOUBLE) AS price FROM hits WHERE rn = 1"""


def price_facts(t):
    kinds = F.element_at(F.array(*[F.lit(k) for k in ("new", "Check", "Renewal", "Hardcopy")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t["orders"].join(t["customer"], F.col("c_custkey") == F.col("o_custkey")).select(
        "o_orderkey",
        F.concat(F.lit("Center NATION_"), (F.col("c_nationkey") % 7).cast("string")).alias("delivery_center"),
        F.col("c_custkey").alias("customer_id"),
        kinds.alias("request_type"),
        F.when(F.col("o_orderstatus") != "O", F.date_add(F.col("o_orderdate").cast("date"), 40)).alias("finished"),
    )


PRICE_KEYS = ["delivery_center", "customer_id", "request_type"]


@query("j11_price_at_date", with_roles("price", PRICE_SQL))
def price_at_date(t):
    return joins.price_at(price_facts(t), t["price"], PRICE_KEYS, "finished", date(1998, 3, 10)).select("o_orderkey", "price")


@query("j11_price_by_calendar", with_roles("price", PRICE_SQL))
def price_by_calendar(t):
    """The same prices, with the windows cut into months and days."""
    priced = intervals.price_by_calendar(price_facts(t), t["price"], PRICE_KEYS, "finished", date(1998, 3, 10))
    return priced.select("o_orderkey", "price")


HIERARCHY_CTE = """WITH RECURSIVE tree(id, root_id) AS (
        SELECT c_custkey, c_custkey FROM customer WHERE c_custkey < 25
        UNION ALL SELECT c.c_custkey, tree.root_id FROM customer c JOIN tree ON tree.id = CAST(floor(c.c_custkey / 2) AS BIGINT)
        WHERE c.c_custkey >= 25)"""


@query(
    "h1_interval_labels",
    f"""{HIERARCHY_CTE}, pairs AS (SELECT id AS node, id AS above FROM tree UNION ALL SELECT p.node, c.c_custkey // 2 FROM pairs p
        JOIN customer c ON c.c_custkey = p.above WHERE p.above >= 25), sizes AS (SELECT above, count(*) AS n FROM pairs GROUP BY above)
        SELECT tree.id, root_id, CAST((SELECT count(*) - 1 FROM pairs WHERE node = tree.id) AS INTEGER) AS depth, n AS size FROM tree
        JOIN sizes ON above = tree.id""",
)
def hierarchy_labels(t):
    return interval_labels(t["sq_customer"]).drop("start")


@query(
    "h1_all_descendants",
    f"""{HIERARCHY_CTE}, pairs AS (SELECT id AS node, id AS above FROM tree UNION ALL SELECT p.node, c.c_custkey // 2 FROM pairs p
        JOIN customer c ON c.c_custkey = p.above WHERE p.above >= 25) SELECT above AS customer_id, node AS node_id FROM pairs""",
)
def all_descendants(t):
    """Every customer with all customers below it, by ranges of pre-order numbers."""
    labels = interval_labels(t["sq_customer"])
    return join_below(labels.select(F.col("id").alias("customer_id")), labels, "customer_id")


@query("h1_top_level_customer", f"{HIERARCHY_CTE} SELECT id, root_id FROM tree")
def top_level_customer(t):
    return top_level(t["sq_customer"])


@query(
    "j12_join_top_level",
    f"""{HIERARCHY_CTE}, owner AS (SELECT n_nationkey AS team_id, c_custkey AS customer_id FROM nation JOIN customer
        ON n_nationkey % 5 = c_custkey % 5 WHERE c_custkey < 25)
        SELECT team_id, customer_id, tree.id AS node_id FROM owner JOIN tree ON tree.root_id = customer_id""",
)
def join_top_level(t):
    owner = t["team_customer"].select("team_id", "customer_id")
    return joins.join_top_level(owner, top_level(t["sq_customer"]), "customer_id")


@query("j12_join_below_roots", SQL["j12_join_top_level"])
def join_below_roots(t):
    """The same pairs by ranges: no root is a join key for all that stands below it."""
    labels = interval_labels(t["sq_customer"])
    roots = labels.filter("depth = 0").select(F.col("id").alias("customer_id"))
    owner = t["team_customer"].select("team_id", "customer_id").join(roots, "customer_id", "left_semi")
    return join_below(owner.select("team_id", "customer_id"), labels, "customer_id")


@query(
    "j13_join_distinct",
    with_roles(
        "request escalation",
        """SELECT r.id, CASE WHEN e.request_id IS NULL THEN 0 ELSE 1 END AS escalated FROM r_request r
        LEFT JOIN (SELECT DISTINCT request_id FROM r_escalation) e ON e.request_id = r.id""",
    ),
)
def join_distinct(t):
    flagged = joins.join_distinct(t["request"].select("id"), t["escalation"], "id", "found", "request_id")
    return flagged.select("id", F.col("found").isNotNull().alias("escalated"))


@query(
    "j14_join_by_name",
    with_roles(
        "contact country",
        """SELECT k.id, c.title FROM r_contact k LEFT JOIN r_country c ON lower(c.short_title) = lower(k.country)""",
    ),
)
def join_by_name(t):
    countries = t["country"].select("short_title", F.col("title").alias("country_title"))
    return joins.join_by_name(t["contact"].drop("title"), countries, "country", "short_title").select(
        "id", F.col("country_title").alias("title")
    )


@query(
    "j15_attach_default",
    with_roles(
        "request contact request_contact",
        """SELECT r.id, c.id AS contact_id, c.email FROM r_request r LEFT JOIN r_contact c ON c.request_id = r.id
        LEFT JOIN (SELECT DISTINCT request_id, contact_id, 1 AS cur FROM r_request_contact WHERE current_contact = 1) d
        ON d.request_id = r.id AND d.contact_id = c.id WHERE cur = 1""",
    ),
)
def attach_default(t):
    requests = t["request"].select(F.col("id").alias("request_id"))
    current = t["request_contact"].filter(F.col("current_contact") == 1)
    attached = joins.attach_default(requests, t["contact"], current)
    return attached.select(F.col("request_id").alias("id"), F.col("id").alias("contact_id"), "email")
