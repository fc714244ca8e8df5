"""The given tables in the roles of the reports.

Each role is one SQL text that Spark and DuckDB both read: Spark runs it over the scanned tables, the check
SQL names it as a common table expression. Only the inputs are shared that way, never an operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from supplyloom.sources.tables import load

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "conversations", "pages")

_PERIOD = "CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 AS STRING)"

ROLES = {
    # --- purchase orders ---
    "record": f"""
        SELECT l_orderkey AS po_number, l_linenumber AS number_of_line_item, {_PERIOD} AS period,
               c_nationkey AS team_id, o_custkey AS customer_id, CAST(l_suppkey AS STRING) AS po_created_by,
               CASE WHEN l_linenumber IN (3, 5) THEN 'U' || CAST(l_linenumber AS STRING) ELSE o_orderpriority END AS category_id,
               l_partkey AS ifa_number,
               'Part ' || CAST(l_partkey AS STRING) AS ifa_supplier_name, l_linestatus AS sap_backend,
               c_nationkey % 5 AS are_id, o_orderdate AS created_at,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
        FROM {{lineitem}} JOIN {{orders}} ON o_orderkey = l_orderkey JOIN {{customer}} ON c_custkey = o_custkey""",
    "po_category": """
        SELECT DISTINCT o_orderpriority AS id, substring(o_orderpriority, 3) AS name FROM {orders}
        WHERE o_orderpriority <> '5-LOW'""",
    "team": "SELECT n_nationkey AS id, n_name AS name, n_nationkey % 7 AS dc_id FROM {nation}",
    "scm_users": "SELECT CAST(s_suppkey AS STRING) AS GID, s_name AS Name FROM {supplier} WHERE s_acctbal > 0",
    "are": "SELECT r_regionkey AS id, r_name AS name FROM {region}",
    # orders requested for a check before
    "po_request": f"""
        SELECT o_orderkey AS po_number, o_orderpriority AS category_id, {_PERIOD} AS period,
               CASE WHEN o_totalprice < 250000 THEN 1 ELSE 3 END AS status_id,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS is_reminder_sent, o_orderdate AS created_at
        FROM {{orders}} WHERE o_orderpriority = '1-URGENT'""",
    "user": """
        SELECT c_custkey AS id, c_nationkey AS team_id, c_name AS full_name, c_name || '@mail' AS email,
               'G' || CAST(c_custkey AS STRING) AS gid, 'L' || CAST(c_custkey AS STRING) AS login,
               c_mktsegment AS department, 'Buyer' AS position, c_mktsegment AS org_unit, 'Site' AS location,
               CAST(c_nationkey AS STRING) AS country, CAST(c_nationkey % 5 AS STRING) AS are,
               CAST(c_custkey AS STRING) AS phone, CAST(c_custkey AS STRING) AS mobile,
               c_mktsegment || ' long' AS department_long,
               CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE 0 END AS is_anonymized
        FROM {customer}""",
    "auth": """
        SELECT c_custkey AS user_id,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'pomodule reader' ELSE 'Reader' END AS item_name FROM {customer}
        UNION ALL
        SELECT c_custkey AS user_id, 'POModule editor' AS item_name FROM {customer}
        WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    # --- activity and mail ---
    "log": "SELECT user_id AS created_by, ts AS created_at FROM {events}",
    "mail": """
        SELECT conv_id AS created_by, turn, role AS sender, role AS recipient, text AS message,
               'subject ' || CAST(turn AS STRING) AS subject FROM {conversations}""",
    # --- requests ---
    "request": """
        SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS input_received, o_orderdate AS created_at,
               o_custkey AS created_by, o_custkey + 7 AS updated_by,
               CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END AS agent_id,
               CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 3 END AS start_date,
               CASE WHEN o_orderstatus = 'F'
                    THEN CASE WHEN o_orderkey % 10 < 7 THEN 4 WHEN o_orderkey % 10 < 9 THEN 5 ELSE 6 END
                    WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 10 < 5 THEN 2 ELSE 3 END
                    ELSE CASE WHEN o_orderkey % 10 < 8 THEN 1 ELSE 7 END END AS status_id,
               CAST(1 + o_orderkey % 6 AS INT) AS type,
               CASE WHEN o_orderstatus = 'F' THEN CAST(shipped AS DATE) END AS finished_date_computed,
               CASE WHEN o_orderkey % 11 = 0 THEN CAST(year(o_orderdate) + 1 AS STRING)
                    WHEN o_orderkey % 11 = 1 THEN '' END AS spillover_fy_calculated,
               CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS not_considered_request_type_calculation,
               CASE WHEN o_orderkey % 5 < 2 THEN 'Wave pega 1' WHEN o_orderkey % 7 = 0 THEN 'x' END AS fss_wave,
               c_nationkey % 7 AS delivery_center_id, o_custkey AS customer_id,
               CAST(o_custkey % 5 AS INT) AS division_id,
               CASE WHEN o_custkey % 6 <> 5 THEN CAST(o_custkey % 5 AS INT) END AS business_unit_id,
               CAST(o_custkey % 25 AS INT) AS country_id, CAST(o_custkey % 5 AS INT) AS are_id,
               supp AS supplier_id, part AS commodity_id, CAST(1 + o_orderkey % 3 AS INT) AS responsible_id,
               CAST(1 + o_orderkey % 4 AS INT) AS current_step_id, o_orderkey AS registration_process_id,
               o_orderkey AS coc_process_id,
               CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey END AS qualification_process_id,
               shipped AS updated_at, CAST(o_orderdate AS DATE) + 30 AS next_target_date,
               o_orderpriority AS next_target_date_source, o_orderpriority AS comments_prioritisation,
               o_totalprice AS expected_pvo, 'open' AS coc_status, 'open' AS crsa_status, 'open' AS cap_status,
               'open' AS sc_status, 'open' AS cs_status,
               CASE WHEN o_orderkey % 3 = 0 THEN 'Version 3' WHEN o_orderkey % 3 = 1 THEN 'version 4 ' END AS cap_version,
               CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderkey % 400 AS INT) END AS total_time_calculated,
               CAST(o_orderkey % 45 AS INT) AS current_step_time_calculated,
               CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) + 10 END AS step_entered,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 10 = 9 THEN CAST(shipped AS DATE) END AS out_of_scope_date,
               CAST(NULL AS STRING) AS out_of_scope_comment,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 10 IN (7, 8) THEN CAST(shipped AS DATE) END
                    AS finished_not_qualified_tick,
               'ORG' || CAST(o_custkey % 25 AS STRING) AS org_code, CAST(o_orderdate AS DATE) + 365 AS next_expiration_date,
               CASE o_orderkey % 8 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '4' WHEN 3 THEN '5' WHEN 4 THEN '9'
                    WHEN 5 THEN '7' WHEN 6 THEN 'see mail' END AS expiration_comment,
               o_orderpriority AS expiration_comment_text,
               CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderkey % 3 AS INT) END AS is_renewal_requested,
               o_orderdate AS on_hold_start, shipped AS on_hold_end,
               CAST(o_orderdate AS DATE) + 1 AS information_sent_to_supplier,
               CAST(o_orderdate AS DATE) + 2 AS information_sent_to_buyer,
               CAST(o_orderkey % 3 AS INT) AS process_type, CAST(o_orderkey % 17 AS INT) AS expected_nr_of_po,
               'type ' || o_orderstatus AS esi_connection_type, CAST(NULL AS STRING) AS reason_for_non_incl_in_esi,
               'reason ' || o_orderstatus AS creation_reason, 'ok' AS bp_check, CAST(o_custkey AS STRING) AS bp_id,
               CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderkey % 3 AS INT) END AS spillover_calculated,
               'ESN' || CAST(o_custkey AS STRING) AS esn_code
        FROM {orders} LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped, min(l_suppkey) AS supp,
                                        min(l_partkey) AS part FROM {lineitem} GROUP BY l_orderkey) AS lines
             ON l_orderkey = o_orderkey LEFT JOIN {customer} ON c_custkey = o_custkey""",
    "request_module": """
        SELECT DISTINCT l_orderkey AS request_id, CASE WHEN l_linenumber = 7 THEN 9 ELSE l_linenumber END AS module_id
        FROM {lineitem} WHERE l_linenumber IN (1, 4, 5, 7)""",
    "qualification": """
        SELECT l_orderkey AS qualification_process_id, CASE WHEN l_linenumber = 7 THEN 9 ELSE l_linenumber END AS module_id,
               CAST(1 + l_orderkey % 3 AS INT) AS is_already_done,
               CASE WHEN max(l_linestatus) = 'O' THEN CAST(max(l_shipdate) AS DATE) END AS finished,
               CASE WHEN l_orderkey % 4 < 2 THEN CAST(l_orderkey % 2 AS INT) END AS cap_needed,
               CASE WHEN l_orderkey % 5 <> 0 THEN CAST(max(l_shipdate) AS DATE) END AS cap_finished,
               CAST(l_orderkey % 12 AS INT) AS cap_implementation_month, CAST(min(l_shipdate) AS DATE) AS request_sent,
               CAST(min(l_shipdate) AS DATE) + 5 AS ehs_officer_request_sent
        FROM {lineitem} WHERE l_linenumber IN (1, 4, 5, 7) GROUP BY l_orderkey, l_linenumber""",
    "qualification_process": """
        SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) + 20 AS request_sent,
               CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS finished_not_qualified,
               CAST(o_orderdate AS DATE) + 21 AS pega_request_sent_qual,
               CAST(o_orderdate AS DATE) + 22 AS request_to_bomcheck_sent FROM {orders}""",
    "coc_process": """
        SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 < 3 THEN 0 WHEN o_orderkey % 7 < 5 THEN 1 END AS available,
               CASE WHEN o_orderkey % 5 <> 1 THEN CAST(o_orderdate AS DATE) + 15 END AS finished,
               CAST(o_orderdate AS DATE) + 9 AS available_date,
               CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderdate AS DATE) + 4 END AS request_sent,
               CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS finished_not_qualified,
               CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) + 6 END AS pega_request_sent_coc FROM {orders}""",
    "registration_process": """
        SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 < 2 THEN CAST(o_orderkey % 2 AS INT) END AS reg_already_available,
               CAST(o_orderdate AS DATE) + 2 AS request_sent,
               CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS finished_not_qualified FROM {orders}""",
    "escalation": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS request_id, 1 + l_linenumber % 4 AS step_id,
               1 + l_linenumber % 3 AS contact_category_id, l_linenumber % 5 AS reason_id, l_linenumber % 4 AS response_id,
               l_linenumber % 5 AS escalation_outcome_id, l_linenumber % 5 AS escalation_outcome_reason_id,
               l_linenumber % 6 AS escalation_outcome_subreason_id, CAST(min(l_shipdate) AS DATE) AS sent,
               CAST(min(l_shipdate) AS DATE) + 7 AS follow_up,
               CASE WHEN l_orderkey % 3 <> 0 THEN CAST(max(l_shipdate) AS DATE) + 17 END AS solved,
               CAST(min(l_shipdate) AS DATE) + 8 AS feedback_sent_date,
               CAST(min(l_shipdate) AS DATE) + 9 AS escalation_outcome_solved_date,
               CAST(min(l_shipdate) AS DATE) + 10 AS feedback_from_customer_received_date
        FROM {lineitem} WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_linenumber""",
    "comment": """
        SELECT conv_id AS request_id, CASE WHEN turn % 5 <> 3 THEN CAST(1 + turn % 4 AS INT) END AS step_id,
               CAST('2024-01-01 08:30:00' AS TIMESTAMP) + CAST(turn AS INT) * INTERVAL '7' HOUR AS created_at, text
        FROM {conversations}""",
    "contact": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS request_id,
               CASE WHEN l_linenumber % 2 = 0 THEN 'Supplier' ELSE 'company' END AS type,
               CASE WHEN l_linenumber < 6 THEN 1 ELSE 2 END AS category_id,
               CASE WHEN l_linenumber = 4 THEN 1 WHEN l_linenumber = 2 THEN 0 END AS is_cc_email, 'Dr' AS title,
               'First ' || CAST(min(l_suppkey) AS STRING) AS first_name, 'Last ' || CAST(min(l_partkey) AS STRING) AS last_name,
               'mail ' || CAST(min(l_suppkey) AS STRING) AS email, CAST(min(l_partkey) AS STRING) AS phone,
               'c' || CAST(min(l_suppkey) % 30 AS STRING) AS country
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "request_contact": """
        SELECT l_orderkey AS request_id, l_orderkey * 10 + l_linenumber AS contact_id,
               CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS current_contact FROM {lineitem}""",
    "global_customer": """
        SELECT c_custkey AS customer_id, CASE WHEN c_acctbal > 2000 THEN 1 ELSE 0 END AS is_global_customer
        FROM {customer} WHERE c_mktsegment <> 'BUILDING'""",
    "status": """
        SELECT n_nationkey AS id, CASE n_nationkey WHEN 1 THEN 'Not started' WHEN 2 THEN 'In process' WHEN 3 THEN 'Escalated'
               WHEN 4 THEN 'Finished' WHEN 5 THEN 'Finished not qualified' WHEN 6 THEN 'Out of scope' ELSE 'On hold' END AS name
        FROM {nation} WHERE n_nationkey BETWEEN 1 AND 7""",
    "step": """
        SELECT n_nationkey AS id, CASE n_nationkey WHEN 1 THEN 'Data Clarification' WHEN 2 THEN 'CoC Acceptance'
               WHEN 3 THEN 'Qualification' ELSE 'Finalization' END AS name FROM {nation} WHERE n_nationkey BETWEEN 1 AND 4""",
    "contact_category": "SELECT n_nationkey AS id, 'Category ' || n_name AS name FROM {nation} WHERE n_nationkey BETWEEN 1 AND 3",
    "escalation_reason": """
        SELECT n_nationkey AS id, 'Reason ' || n_name AS reason,
               CASE WHEN n_nationkey <> 2 THEN 'Subreason ' || n_name END AS subreason
        FROM {nation} WHERE n_nationkey BETWEEN 1 AND 4""",
    "escalation_response": "SELECT n_nationkey AS id, 'Response ' || n_name AS name FROM {nation} WHERE n_nationkey < 3",
    "escalation_outcome": "SELECT n_nationkey AS id, 'Outcome ' || n_name AS name FROM {nation} WHERE n_nationkey < 4",
    "escalation_outcome_reason": "SELECT n_nationkey AS id, 'OR ' || n_name AS name FROM {nation} WHERE n_nationkey < 4",
    "escalation_outcome_subreason": "SELECT n_nationkey AS id, 'OS ' || n_name AS name FROM {nation} WHERE n_nationkey < 4",
    "dc": "SELECT n_nationkey AS id, 'Center ' || n_name AS name FROM {nation} WHERE n_nationkey < 6",
    "country": "SELECT n_nationkey AS id, n_name AS title, 'C' || CAST(n_nationkey AS STRING) AS short_title FROM {nation}",
    "division": "SELECT r_regionkey AS id, 'Division ' || r_name AS name FROM {region}",
    "business_unit": "SELECT r_regionkey AS id, 'Unit ' || r_name AS name FROM {region} WHERE r_regionkey < 4",
    "sq_supplier": """
        SELECT s_suppkey AS id, s_suppkey + 1000 AS ifa, s_name AS ifa_supplier_name, s_nationkey AS country_id FROM {supplier}""",
    "commodity": "SELECT p_partkey AS id, p_name AS name, p_size % 12 AS category_id FROM {part}",
    "commodity_category": """
        SELECT n_nationkey AS id, 'Commodity ' || n_name AS name,
               CASE WHEN n_nationkey % 3 < 2 THEN n_nationkey % 3 END AS is_indirect FROM {nation} WHERE n_nationkey < 10""",
    # --- customers, services, KPIs ---
    "sq_customer": """
        SELECT c_custkey AS id, CASE WHEN c_custkey >= 25 THEN CAST(floor(c_custkey / 2) AS BIGINT) END AS parent_id,
               c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN '19960100' END AS valid_from,
               CASE WHEN c_custkey % 4 = 0 THEN '19981200' END AS valid_to, CAST(c_custkey % 5 AS INT) AS division_id,
               CAST(c_custkey % 6 AS INT) AS business_unit_id, c_nationkey AS country_id FROM {customer}""",
    "team_customer": """
        SELECT CAST(n_nationkey AS BIGINT) * 1000000000 + c_custkey AS id, n_nationkey AS team_id, c_custkey AS customer_id,
               CASE WHEN n_nationkey % 4 = 0 THEN '19970100' END AS valid_from,
               CASE WHEN n_nationkey % 5 = 0 THEN '19980600' END AS valid_to
        FROM {nation} JOIN {customer} ON n_nationkey % 5 = c_custkey % 5""",
    "service_name": """
        SELECT r_regionkey AS id, CASE r_regionkey WHEN 0 THEN 'Supplier Qualification' WHEN 1 THEN 'Supplier qualification plus'
               ELSE 'Other service' END AS name FROM {region} WHERE r_regionkey < 3""",
    "service": """
        SELECT CAST(n_nationkey AS BIGINT) * 1000000000 + c_custkey AS id,
               CAST(n_nationkey AS BIGINT) * 1000000000 + c_custkey AS team_customer_id,
               CASE WHEN c_custkey % 10 < 7 THEN 0 WHEN c_custkey % 10 < 9 THEN 1 ELSE 2 END AS service_name_id,
               CASE WHEN n_nationkey % 6 = 0 THEN '19970400' END AS valid_from, CAST(NULL AS STRING) AS valid_to
        FROM {nation} JOIN {customer} ON n_nationkey % 5 = c_custkey % 5""",
    "kpi_name": """
        SELECT n_nationkey AS id, CASE n_nationkey
                 WHEN 0 THEN 'Number of received Supplier Qualifications (Input)'
                 WHEN 1 THEN 'Number of finished Supplier Qualifications (New)'
                 WHEN 2 THEN 'Number of finished Supplier Qualifications (Check)'
                 WHEN 3 THEN 'Number of finished Supplier Qualifications (Renewal)'
                 WHEN 4 THEN 'Number of finished Supplier Qualifications (Hardcopy)'
                 WHEN 5 THEN 'Number of finished Supplier Qualifications (New CoC + Modules)'
                 WHEN 6 THEN 'Number of finished Supplier Qualifications (New CoC only)'
                 WHEN 7 THEN 'Number of finished Supplier Qualifications (New Modules only)'
                 WHEN 8 THEN 'Number of finished Supplier Qualifications (Hard Copy)'
                 WHEN 9 THEN 'Number of finished Supplier Qualifications (Referencing)'
                 ELSE 'Calculated value' END AS name,
               10 - n_nationkey AS priority, CASE WHEN n_nationkey < 3 THEN 1 WHEN n_nationkey < 5 THEN 3 ELSE 2 END AS kpi_kind
        FROM {nation} WHERE n_nationkey < 11""",
    "kpi_tag": "SELECT n_nationkey AS kpi_name_id, CASE WHEN n_nationkey = 4 THEN 2 ELSE 1 END AS tag_id FROM {nation} WHERE n_nationkey < 11",
    "kpi": """
        SELECT DISTINCT service_id * 20 + kpi_name_id AS id, service_id, team_id, kpi_name_id, CAST(NULL AS STRING) AS valid_from,
               CASE WHEN kpi_name_id = 3 THEN '19980100' END AS valid_to
        FROM (SELECT c_nationkey AS team_id, CAST(c_custkey % 11 AS INT) AS kpi_name_id,
                     CAST(c_nationkey AS BIGINT) * 1000000000 + c_nationkey % 5 + 5 * CAST(c_custkey % 5 AS INT) AS service_id
              FROM {customer}) AS offered""",
    "customer_visibility": """
        SELECT c_custkey AS id, c_nationkey AS team_id, 0 AS service_name_id, c_custkey AS customer_unit_id,
               CASE WHEN c_custkey % 3 <> 0 THEN '19970100' END AS valid_from,
               CASE WHEN c_custkey % 2 = 0 THEN '19980200' END AS valid_to FROM {customer}""",
    # the level of each customer unit with an order in the period
    "consolidation": f"""
        SELECT customer_unit_id, n_nationkey AS team_id, 0 AS service_name_id, period,
               CASE WHEN (customer_unit_id + n_nationkey) % 3 = 0 THEN 'consolidated'
                    WHEN (customer_unit_id + n_nationkey) % 3 = 1 THEN 'Inputed' ELSE 'inputed' END AS consolidation
        FROM (SELECT DISTINCT o_custkey AS customer_unit_id, {_PERIOD} AS period FROM {{orders}}) AS ordered
        JOIN {{nation}} ON n_nationkey >= 0""",
    # prices per team, KPI, customer unit and fiscal year of the orders
    "kpi_threshold": """
        SELECT (CAST(c_nationkey AS BIGINT) * 1000000000 + root) * 20 + CAST(c_custkey % 11 AS INT) AS kpi_id, c_custkey AS customer_id,
               CAST(fy - 1 AS STRING) || '1000' AS valid_from,
               CASE WHEN fy < 2001 THEN CAST(CASE WHEN c_custkey % 7 = 0 THEN 2018 ELSE fy END AS STRING) || '0900' END AS valid_to,
               CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 90 + fy % 10 AS DECIMAL(18,2)) END AS price,
               CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 40 AS INT) END AS fiscal_year_target,
               CAST(c_custkey % 1000 AS INT) AS budget_total, CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END AS charging_type
        FROM (SELECT DISTINCT c_custkey, c_nationkey, c_nationkey % 5 + 5 * CAST(c_custkey % 5 AS INT) AS root,
                     CASE WHEN month(o_orderdate) >= 10 THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END AS fy
              FROM {customer} JOIN {orders} ON o_custkey = c_custkey) AS yearly""",
    # the dashboard as the KPI report reads it
    "dash": """
        SELECT o_orderkey AS record_id, CAST(o_orderdate AS DATE) AS input_received,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 45 END AS finished_date,
               CASE o_orderkey % 5 WHEN 0 THEN 'New' WHEN 1 THEN 'check' WHEN 2 THEN 'Renewal' WHEN 3 THEN 'Hardcopy'
                    ELSE 'Referencing' END AS request_type,
               CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 10 < 7 THEN 'Finished' ELSE 'Finished not qualified' END
                    ELSE 'In process' END AS status,
               'Center NATION_' || CAST(c_nationkey % 7 AS STRING) AS delivery_center, c_name AS customer_name,
               CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS doubles
        FROM {orders} JOIN {customer} ON c_custkey = o_custkey""",
    # price windows per center, customer and request type
    "price": """
        SELECT 'Center NATION_' || CAST(c_nationkey % 7 AS STRING) AS delivery_center, c_custkey AS customer_id,
               CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'New' WHEN 1 THEN 'Check' WHEN 2 THEN 'renewal' ELSE 'Hardcopy' END
                   AS request_type,
               CAST(year(o_orderdate) AS STRING) || '0100' AS valid_from,
               CASE WHEN o_orderkey % 3 <> 0 THEN CAST(year(o_orderdate) + o_orderkey % 2 AS STRING) || '1200' END AS valid_to,
               CAST(max(o_orderkey % 1000) AS DECIMAL(18,2)) AS price
        FROM {orders} JOIN {customer} ON c_custkey = o_custkey GROUP BY 1, 2, 3, 4, 5""",
}

# Spark joins in the order of the text: the orders find their customers before the lines, so that those are dealt out once, by
# order. The rows are those of the role.
LINES_FIRST = "FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey JOIN {customer} ON c_custkey = o_custkey"
ORDERS_FIRST = "FROM {lineitem} JOIN ({orders} JOIN {customer} ON c_custkey = o_custkey) ON o_orderkey = l_orderkey"


class Roles:
    """Given tables and roles of one data folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in TABLES:
                self._cache[name] = load(self.spark, self.folder, name)
            else:
                sql = ROLES[name].replace(LINES_FIRST, ORDERS_FIRST)
                used = {table: self[table] for table in TABLES if "{" + table + "}" in sql}
                self._cache[name] = self.spark.sql(sql, **used)
        return self._cache[name]

    def pick(self, *names: str, **renamed: str) -> dict[str, DataFrame]:
        """Tables by the names a report uses: ``pick("team", customer="sq_customer")``."""
        return {name: self[name] for name in names} | {new: self[name] for new, name in renamed.items()}


def role_sql(name: str) -> str:
    return ROLES[name].format(**{table: table for table in TABLES})


def with_roles(roles: str, body: str) -> str:
    """Check SQL: the named roles as common table expressions ``r_<role>`` in front of ``body``.

    ``body`` is a SELECT, or a comma, further expressions and a SELECT.
    """
    ctes = ", ".join(f"r_{name} AS ({role_sql(name)})" for name in roles.split())
    return f"WITH {ctes}{body}" if body.lstrip().startswith(",") else f"WITH {ctes} {body}"
