"""Projection, labels and filters PF1-PF16."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from supplyloom.functions import dates, labels, text
from supplyloom.operators.scope import current_fy_scope
from supplyloom.queries.registry import query
from supplyloom.queries.roles import with_roles

AS_OF = date(1998, 3, 10)


@query(
    "pf1_pf2_select_and_drop",
    """SELECT o_orderkey AS record_id, CAST(o_orderdate AS DATE)::VARCHAR AS input_received, o_custkey * 2 AS doubled FROM orders""",
)
def select_and_drop(t):
    picked = text.select_as(
        t["orders"],
        {
            "record_id": "o_orderkey",
            "input_received": F.col("o_orderdate").cast("date"),
            "doubled": F.col("o_custkey") * 2,
            "helper": "o_orderstatus",
        },
    )
    return picked.drop("helper")


@query(
    "pf3_decode_codes",
    with_roles(
        "request",
        """SELECT id, CASE is_renewal_requested WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' ELSE '' END AS renewal,
        CASE spillover_calculated WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' ELSE 'Unknown' END AS spillover,
        CASE process_type WHEN 0 THEN 'Old Process' WHEN 1 THEN 'New SCM Star Process' END AS process,
        CASE type WHEN 1 THEN 'Yes' WHEN 2 THEN 'No' WHEN 3 THEN 'Deactivated' ELSE 'Unknown' END AS done,
        CASE WHEN lower(rtrim(cap_version)) = 'version 3' THEN 'CRSA v3.0' WHEN lower(rtrim(cap_version)) = 'version 4'
        THEN 'CRSA v4.0' ELSE '' END AS version FROM r_request""",
    ),
)
def decode_codes(t):
    return t["request"].select(
        "id",
        labels.decode(F.col("is_renewal_requested"), labels.YES_NO_LABELS, "").alias("renewal"),
        labels.decode(F.col("spillover_calculated"), labels.YES_NO_LABELS, "Unknown").alias("spillover"),
        labels.decode(F.col("process_type"), labels.PROCESS_TYPES).alias("process"),
        labels.decode(F.col("type"), labels.DONE_LABELS, "Unknown").alias("done"),
        labels.decode(F.col("cap_version"), labels.CAP_VERSIONS, "").alias("version"),
    )


@query(
    "pf4_range_buckets",
    with_roles(
        "request",
        """SELECT id, CASE WHEN total_time_calculated IS NULL THEN 'a) blank' WHEN total_time_calculated < 100 THEN 'b) 0-99'
        WHEN total_time_calculated < 200 THEN 'c) 199 - 100' WHEN total_time_calculated < 300 THEN 'd) 200 - 299'
        ELSE 'e) 300 and above' END AS total_time, CASE WHEN total_time_calculated IS NULL THEN '0) missing data'
        WHEN total_time_calculated <= 5 THEN 'a) less 1 weeks' WHEN total_time_calculated <= 10 THEN 'b) 1 - 2 weeks'
        WHEN total_time_calculated <= 20 THEN 'c) 2 - 4 weeks' WHEN total_time_calculated <= 40 THEN 'd) 4 - 8 weeks'
        ELSE 'e) more then 8 weeks' END AS age FROM r_request""",
    ),
)
def range_buckets(t):
    days = F.col("total_time_calculated")
    return t["request"].select(
        "id", labels.total_time_label(days).alias("total_time"), labels.age_label(days).alias("age")
    )


STEP_THRESHOLD_SQL = """CASE lower(s.name)
        WHEN 'data clarification' THEN CASE WHEN d <= 15 THEN 'a) < 3 weeks' WHEN d > 15 THEN 'c) > 3 weeks' END
        WHEN 'coc acceptance' THEN CASE WHEN d <= 10 THEN 'a) < 2 weeks' WHEN d <= 20 THEN 'b) < 2-4 weeks'
             WHEN d > 20 THEN 'c) > 3 weeks' END
        WHEN 'qualification' THEN CASE WHEN d <= 15 THEN 'a) < 3 weeks ' WHEN d <= 25 THEN 'b) 3-5 weeks'
             WHEN d > 25 THEN 'c) > 5 weeks' END
        WHEN 'finalization' THEN CASE WHEN d <= 5 THEN 'a) < 1 week' WHEN d > 5 THEN 'b) > 1 week' END END"""


@query(
    "pf5_step_thresholds",
    with_roles(
        "request step",
        f"""SELECT r.id, {STEP_THRESHOLD_SQL} AS threshold
        FROM (SELECT *, current_step_time_calculated AS d FROM r_request) r LEFT JOIN r_step s ON s.id = current_step_id""",
    ),
)
def step_thresholds(t):
    steps = t["step"].select(F.col("id").alias("current_step_id"), F.col("name").alias("step"))
    return t["request"].join(steps, "current_step_id", "left").select(
        "id", labels.step_time_label(F.col("step"), F.col("current_step_time_calculated")).alias("threshold")
    )


@query(
    "pf6_pf7_pf16_defaults",
    with_roles(
        "request",
        """SELECT id, coalesce(agent_id, updated_by) AS first_agent,
        CASE WHEN length(rtrim(fss_wave)) > 1 THEN fss_wave ELSE '' END AS wave,
        CASE WHEN length(rtrim(spillover_fy_calculated)) > 1 THEN spillover_fy_calculated
             ELSE CAST(year(input_received) AS VARCHAR) END AS year,
        CASE WHEN agent_id IS NOT NULL THEN 'global' ELSE 'local' END AS scope FROM r_request""",
    ),
)
def defaults(t):
    return t["request"].select(
        "id",
        text.first_present(F.col("agent_id"), F.col("updated_by")).alias("first_agent"),
        text.text_or(F.col("fss_wave"), "").alias("wave"),
        text.text_or(F.col("spillover_fy_calculated"), F.year("input_received").cast("string")).alias("year"),
        text.presence_label(F.col("agent_id"), "global", "local").alias("scope"),
    )


@query(
    "pf8_first_true_label",
    with_roles(
        "qualification_process coc_process registration_process",
        """SELECT q.id, CASE WHEN q.finished_not_qualified = 1 THEN 'Qualification Step' WHEN c.finished_not_qualified = 1
        THEN 'CoC Step' WHEN r.finished_not_qualified = 1 THEN 'Old Registration Step' END AS step
        FROM r_qualification_process q JOIN r_coc_process c ON c.id = q.id JOIN r_registration_process r ON r.id = q.id""",
    ),
)
def first_true_label(t):
    def flag(role, name):
        return t[role].select("id", F.col("finished_not_qualified").alias(name))

    joined = flag("qualification_process", "q").join(flag("coc_process", "c"), "id").join(flag("registration_process", "r"), "id")
    return joined.select("id", labels.not_qualified_step(F.col("q"), F.col("c"), F.col("r")).alias("step"))


@query(
    "pf9_mixed_codes",
    with_roles(
        "request",
        """SELECT id, CASE WHEN TRY_CAST(expiration_comment AS DOUBLE) IS NULL THEN expiration_comment ELSE
        CASE expiration_comment WHEN '0' THEN 'Unlimited' WHEN '1' THEN 'Other' WHEN '4' THEN 'CRSA' WHEN '5' THEN 'SC'
        WHEN '9' THEN 'CS' END END AS comment, CASE WHEN TRY_CAST(expiration_comment AS DOUBLE) IS NULL THEN ''
        ELSE expiration_comment_text END AS comment_text FROM r_request""",
    ),
)
def mixed_codes(t):
    code = F.col("expiration_comment")
    return t["request"].select(
        "id",
        labels.decode_mixed(code, labels.EXPIRATION_CODES).alias("comment"),
        labels.mixed_text(code, F.col("expiration_comment_text")).alias("comment_text"),
    )


SCOPE_SQL = """(status_id IN (1, 2, 3, 7) OR (status_id IN (4, 5, 6) AND
        CASE WHEN length(rtrim(spillover_fy_calculated)) > 1 THEN spillover_fy_calculated ELSE
             CAST(CASE WHEN month(input_received) >= 10 THEN year(input_received) + 1 ELSE year(input_received) END AS VARCHAR)
        END = '1998'))"""


@query(
    "pf10_current_year_scope",
    with_roles("request", f"SELECT id, status_id, input_received::VARCHAR AS input_received FROM r_request WHERE {SCOPE_SQL}"),
)
def current_year_scope(t):
    return current_fy_scope(t["request"], AS_OF).select("id", "status_id", "input_received")


@query(
    "pf11_pf15_predicates",
    with_roles(
        "request",
        """SELECT id FROM r_request WHERE (type IN (1, 2, 4) OR lower(fss_wave) LIKE '%pega%') AND agent_id IS NOT NULL
        AND input_received BETWEEN DATE '1995-02-01' AND DATE '2001-02-01' AND NOT creation_reason LIKE '%P' AND created_by IN
        (SELECT created_by FROM r_request GROUP BY created_by)""",
    ),
)
def predicates(t):
    """IN lists, LIKE, NULL tests and ranges. A key tested against its own table is just not NULL."""
    return t["request"].filter(
        (F.col("type").isin(1, 2, 4) | F.lower("fss_wave").like("%pega%"))
        & F.col("agent_id").isNotNull()
        & F.col("input_received").between(date(1995, 2, 1), date(2001, 2, 1))
        & ~F.col("creation_reason").like("%P")
        & F.col("created_by").isNotNull()
    ).select("id")


@query(
    "pf12_valid_at_period",
    with_roles(
        "sq_customer",
        """SELECT o_orderkey FROM orders JOIN r_sq_customer ON id = o_custkey WHERE
        (strftime(o_orderdate, '%Y%m') || '00' >= valid_from OR valid_from IS NULL)
        AND (strftime(o_orderdate, '%Y%m') || '00' <= valid_to OR valid_to IS NULL)""",
    ),
)
def valid_at_period(t):
    joined = t["orders"].join(t["sq_customer"], F.col("o_custkey") == F.col("id"))
    period = dates.period_of(F.col("o_orderdate"))
    return joined.filter(dates.valid_at(period, F.col("valid_from"), F.col("valid_to"))).select("o_orderkey")


CURRENT_STEP_SQL = """CASE WHEN lower(st.name) = 'not started' THEN 'a) Not Started' WHEN lower(st.name) = 'finished' THEN 'f) Finished'
        WHEN lower(st.name) = 'finished not qualified' THEN 'g) Finished not qualified'
        WHEN lower(st.name) = 'out of scope' THEN 'h) Out of scope'
        WHEN lower(tab.name) = 'data clarification' AND e.solved IS NULL THEN 'b) Data clarification'
        WHEN lower(s.name) = 'coc acceptance' THEN 'c) CoC Acceptance' WHEN lower(s.name) = 'qualification' THEN 'd) Qualification'
        WHEN lower(s.name) = 'finalization' THEN 'e) Finalization' END"""


@query(
    "pf13_current_step",
    with_roles(
        "request status step escalation",
        f"""SELECT r.id, e.id AS escalation_id, {CURRENT_STEP_SQL} AS current_step FROM r_request r
        LEFT JOIN r_status st ON st.id = status_id LEFT JOIN r_step s ON s.id = current_step_id
        LEFT JOIN r_escalation e ON e.request_id = r.id LEFT JOIN r_step tab ON tab.id = e.step_id""",
    ),
)
def current_step(t):
    from supplyloom.operators.joins import Lookup, denormalize, fan_out

    requests = denormalize(
        t["request"].select("id", "status_id", "current_step_id"),
        [Lookup(t["status"], "status_id", {"status": "name"}), Lookup(t["step"], "current_step_id", {"step": "name"})],
    )
    escalations = denormalize(t["escalation"], [Lookup(t["step"], "step_id", {"tab": "name"})]).select(
        F.col("request_id").alias("id"), F.col("id").alias("escalation_id"), "tab", "solved"
    )
    label = labels.current_step(F.col("status"), F.col("tab"), F.col("solved"), F.col("step"))
    return fan_out(requests, escalations, "id", "escalation_id").select("id", "escalation_id", label.alias("current_step"))


@query(
    "pf14_kpi_and_request_type",
    with_roles(
        "kpi_name kpi dash",
        """SELECT k.id AS item, CASE n.name
        WHEN 'Number of finished Supplier Qualifications (New CoC + Modules)' THEN 'New (CoC+Modules)'
        WHEN 'Number of finished Supplier Qualifications (New CoC only)' THEN 'New (Coc Only)'
        WHEN 'Number of finished Supplier Qualifications (New Modules only)' THEN 'New (Modules only)'
        WHEN 'Number of finished Supplier Qualifications (Check)' THEN 'Check'
        WHEN 'Number of finished Supplier Qualifications (Renewal)' THEN 'Renewal'
        WHEN 'Number of finished Supplier Qualifications (Hard Copy)' THEN 'Hardcopy'
        WHEN 'Number of finished Supplier Qualifications (Referencing)' THEN 'Referencing' END AS label
        FROM r_kpi k JOIN r_kpi_name n ON n.id = k.kpi_name_id
        UNION ALL SELECT record_id, CASE lower(request_type) WHEN 'new' THEN 'Number of finished Supplier Qualifications (New)'
        WHEN 'check' THEN 'Number of finished Supplier Qualifications (Check)'
        WHEN 'renewal' THEN 'Number of finished Supplier Qualifications (Renewal)'
        WHEN 'hardcopy' THEN 'Number of finished Supplier Qualifications (Hardcopy)' END FROM r_dash""",
    ),
)
def kpi_and_request_type(t):
    names = t["kpi_name"].select(F.col("id").alias("kpi_name_id"), "name")
    forward = t["kpi"].join(names, "kpi_name_id").select(
        F.col("id").cast("bigint").alias("item"), labels.kpi_to_request_type(F.col("name")).alias("label")
    )
    back = t["dash"].select(F.col("record_id").alias("item"), labels.request_type_to_kpi(F.col("request_type")).alias("label"))
    return forward.unionByName(back)
