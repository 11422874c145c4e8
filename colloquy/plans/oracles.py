"""The same results in plain SQL, written without the library, for cross-checking."""

from __future__ import annotations

from colloquy.functions import fixed_values as fixed
from colloquy.plans.queries import DIGITS

AS_OF = "TIMESTAMP '1998-01-31 09:30:00'"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# ---------------------------------------------------------------- views

VIEWS: dict[str, tuple[list[str], str]] = {
    "pairs": ([], """
        SELECT conv_id * (SELECT max(turn) + 1 FROM conversations) + turn AS example_id, text AS instruction, nt AS response,
               'intent_' || (conv_id % 7) AS intent, 'category_' || (conv_id % 3) AS category, conv_id, turn
        FROM (SELECT conv_id, turn, role, text,
                     lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nr,
                     lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nt FROM conversations)
        WHERE role = 'user' AND nr = 'assistant'"""),
    "dialogues": ([], """
        SELECT d.doc_id AS example_id, split_part(d.text, chr(10), 1) AS instruction, d.text AS response,
               d.source AS intent, d.lang AS category,
               CASE WHEN l.quality IS NOT NULL THEN
                 (CASE WHEN l.quality = 0 THEN 'B' ELSE '' END) || (CASE WHEN l.toxic = 1 THEN 'I' ELSE '' END)
               END AS flags
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""),
    "pred_base": (["pairs"], "SELECT *, instruction AS prediction, length(response) * 2.5::DOUBLE AS latency_ms FROM pairs"),
    "runs": (["pred_base"], "SELECT *, ['click', 'error', 'purchase', 'signup', 'view'][example_id % 5 + 1] AS run FROM pred_base"),
    "pred_ft": (["pairs"], """
        SELECT *, substr(response, 1, length(response) // 2) AS prediction,
               length(instruction) * 12.5::DOUBLE AS latency_ms FROM pairs"""),
    "doc_predictions": (["dialogues"], """
        SELECT *, substr(response, 1, length(response) // 2) AS prediction, length(response) * 1.5::DOUBLE AS latency_ms FROM dialogues"""),
    "latency": ([], """
        SELECT event_id, event_type AS label, CASE WHEN event_id % 997 <> 5 THEN value END AS latency_ms,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS response_tokens, props AS prompt FROM events"""),
    "kevents": ([], """
        SELECT event_id AS example_id, event_type AS label,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""),
    "orders_state": ([], """
        SELECT 'ORD-' || o_orderkey AS sid,
               CASE WHEN o_orderstatus = 'F' THEN 'delivered'
                    WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 10 = 1 THEN 'out_for_delivery' ELSE 'shipped' END
                    ELSE CASE WHEN o_orderkey % 10 = 0 THEN 'cancelled' ELSE 'processing' END END AS status,
               CAST(o_orderdate AS DATE) AS order_date, CAST(o_orderdate AS DATE) + 6 AS estimated_delivery,
               CAST(o_orderdate AS DATE) + 5 AS delivered,
               ['FedEx', 'UPS', 'USPS', 'DHL'][o_orderkey % 4 + 1] AS carrier,
               upper(substr(['FedEx', 'UPS', 'USPS', 'DHL'][o_orderkey % 4 + 1], 1, 2))
                 || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS tracking_number,
               o_orderpriority AS item, o_orderpriority || 'x1' AS items, o_totalprice AS total, o_custkey || ' Main St' AS shipping_address
        FROM orders"""),
    "accounts_state": ([], """
        SELECT lower(c_name) || '@x' AS sid,
               CASE c_custkey % 5 WHEN 3 THEN 'suspended' WHEN 4 THEN 'cancelled' ELSE 'active' END AS account_status,
               CASE WHEN c_custkey % 31 = 0 THEN 'Legacy' ELSE ['Basic', 'Standard', 'Premium'][c_custkey % 3 + 1] END AS subscription_plan,
               DATE '1998-01-01' - CAST(c_custkey % 900 AS INTEGER) AS member_since,
               c_custkey % 50 + 1 AS total_orders, c_custkey * 37 % 5001 AS loyalty_points,
               'Card ' || c_mktsegment AS payment_method, 'monthly' AS billing_cycle,
               DATE '1998-02-01' + CAST(c_custkey % 28 AS INTEGER) AS next_billing_date
        FROM customer"""),
    "requests": ([], """
        SELECT o_orderkey AS request_id,
               ['lookup_order', 'update_shipping_address', 'cancel_order', 'get_return_label', 'get_account_info',
                'unlock_account', 'update_subscription', 'cancel_subscription', 'process_refund',
                'reset_router'][o_orderkey % 10 + 1] AS action,
               CASE WHEN o_orderkey % 50 = 0 THEN 'BAD-' || o_orderkey
                    WHEN o_orderkey % 33 = 0 THEN 'ORD-X' || o_orderkey ELSE 'ORD-' || o_orderkey END AS order_id,
               CASE WHEN o_orderkey % 40 = 0 THEN 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
                    WHEN o_orderkey % 37 = 0 THEN 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '@y'
                    ELSE 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '@x' END AS email,
               ['Basic', 'Standard', 'Premium', 'Platinum'][o_orderkey % 4 + 1] AS new_plan,
               CASE WHEN o_orderkey % 100 = 0 THEN 0.0::DOUBLE WHEN o_orderkey % 101 = 0 THEN 500.0::DOUBLE
                    WHEN o_orderkey % 103 = 0 THEN NULL
                    ELSE floor(o_totalprice / 5.0::DOUBLE) / 100.0::DOUBLE END AS amount,
               o_orderpriority || ' Road' AS new_address, 'status ' || o_orderstatus AS reason,
               'the "' || o_orderpriority || '" one' AS item_name, 'priority ' || o_orderpriority AS return_reason
        FROM orders"""),
    "agent_texts": (["requests"], """
        SELECT *, CASE WHEN tool IS NULL THEN NULL WHEN tool = 'reset_router' THEN 'unknown_tool' WHEN fits THEN 'ok' ELSE 'bad_arguments' END AS call_code,
               CASE WHEN request_id % 11 = 0 THEN 'Our returns desk is open.' || chr(10) || 'Anything else?'
                    WHEN request_id % 13 = 0 THEN 'TOOL_CALL: ' || action
                    ELSE 'Let me check that.' || chr(10) || '  TOOL_CALL: ' || action || '(' || CASE
                        WHEN request_id % 7 = 0 THEN '{broken' WHEN request_id % 17 = 0 THEN '{"order_number": "' || order_id || '"}'
                        WHEN request_id % 23 = 0 THEN '{' || json || '}{' || json || '}' WHEN request_id % 29 = 0 THEN '{' || json || '}) (as asked'
                        ELSE '{' || json || '}' END || ')' || CASE WHEN request_id % 19 = 0 THEN ' please' ELSE '' END || chr(10) || 'One moment.' END AS text
        FROM (SELECT *, CASE WHEN request_id % 11 = 0 OR request_id % 13 = 0 THEN NULL ELSE action END AS tool,
                     request_id % 7 <> 0 AND request_id % 17 <> 0 AND request_id % 23 <> 0 AND request_id % 29 <> 0 AS fits,
                     request_id % 7 <> 0 AND request_id % 17 = 0 AS misnamed,
                     CASE action
                       WHEN 'lookup_order' THEN oid WHEN 'update_shipping_address' THEN oid || ', "new_address": "' || new_address || '"'
                       WHEN 'cancel_order' THEN oid || why
                       WHEN 'get_return_label' THEN oid || ', "item_name": "' || replace(item_name, '"', chr(92) || '"') || '", "return_reason": "' || return_reason || '"'
                       WHEN 'get_account_info' THEN mail WHEN 'unlock_account' THEN mail
                       WHEN 'update_subscription' THEN mail || ', "new_plan": "' || new_plan || '"' WHEN 'cancel_subscription' THEN mail || why
                       WHEN 'process_refund' THEN mail || ', ' || oid || ', "amount": ' || coalesce(printf('%.2f', amount), '"NaN"') || ', "reason": "' || reason || '"'
                       ELSE oid END AS json
              FROM (SELECT *, '"order_id": "' || order_id || '"' AS oid, '"customer_email": "' || email || '"' AS mail,
                           CASE WHEN request_id % 3 = 0 THEN ', "reason": "' || reason || '"' ELSE '' END AS why FROM requests))"""),
    "asked": (["agent_texts"], """
        SELECT request_id, tool, fits, misnamed,
               CASE WHEN fits AND tool IN ('lookup_order', 'update_shipping_address', 'cancel_order', 'get_return_label', 'process_refund', 'reset_router') THEN order_id END AS order_id,
               CASE WHEN fits AND tool IN ('get_account_info', 'unlock_account', 'update_subscription', 'cancel_subscription', 'process_refund') THEN email END AS email,
               CASE WHEN fits AND tool = 'update_subscription' THEN new_plan END AS new_plan,
               CASE WHEN fits AND tool = 'process_refund' THEN amount END AS amount, CASE WHEN fits AND tool = 'process_refund' AND amount IS NULL THEN 'NaN' END AS no_amount,
               CASE WHEN fits AND tool = 'update_shipping_address' THEN new_address END AS new_address,
               CASE WHEN fits AND (tool = 'process_refund' OR tool IN ('cancel_order', 'cancel_subscription') AND request_id % 3 = 0) THEN reason END AS reason,
               CASE WHEN fits AND tool = 'get_return_label' THEN item_name END AS item_name,
               CASE WHEN fits AND tool = 'get_return_label' THEN return_reason END AS return_reason, order_id AS whole_order_id
        FROM agent_texts WHERE tool IS NOT NULL"""),
    "with_order": (["requests", "orders_state"], """
        SELECT r.*, s.*, CASE WHEN NOT starts_with(r.order_id, 'ORD-') THEN 'invalid_order_id'
                              WHEN s.sid IS NULL THEN 'order_not_found' END AS bad_order
        FROM requests r LEFT JOIN orders_state s ON s.sid = r.order_id"""),
    "with_account": (["requests", "accounts_state"], """
        SELECT r.*, s.*, CASE WHEN NOT contains(r.email, '@') THEN 'invalid_email'
                              WHEN s.sid IS NULL THEN 'account_not_found' END AS bad_account
        FROM requests r LEFT JOIN accounts_state s ON s.sid = r.email"""),
    "rating": (["kevents"], """
        SELECT example_id, label, bad,
               CASE WHEN NOT bad THEN CAST(k % 5 + 1 AS DOUBLE) END AS helpfulness,
               CASE WHEN NOT bad THEN CAST((k + 1) % 5 + 1 AS DOUBLE) END AS accuracy,
               CASE WHEN NOT bad THEN CAST((k + 2) % 5 + 1 AS DOUBLE) END AS professionalism,
               CASE WHEN bad THEN 'error' ELSE 'k' || k END AS reasoning,
               CASE WHEN bad THEN NULL WHEN k % 2 = 0 THEN 'A' ELSE 'B' END AS winner
        FROM (SELECT *, k % 10 IN (0, 3, 6) AS bad FROM kevents)"""),
    "judged": (["rating"], """
        SELECT label, avg(helpfulness) AS avg_helpfulness, avg(accuracy) AS avg_accuracy,
               avg(professionalism) AS avg_professionalism,
               avg((helpfulness + accuracy + professionalism) / 3) AS avg_composite,
               count(*) FILTER (NOT bad) AS n_valid, count(*) FILTER (bad) AS n_failed
        FROM rating GROUP BY label HAVING count(*) FILTER (NOT bad) > 0"""),
    "details": (["pairs"], """
        SELECT *, row_number() OVER (ORDER BY example_id) - 1 AS position, example_id % 97 AS k,
               example_id % 97 % 10 NOT IN (0, 3, 6) AS good FROM pairs"""),
    "preferred": (["details"], """
        SELECT *, CASE WHEN NOT good THEN NULL WHEN k % 2 = 0 THEN 'A' ELSE 'B' END AS winner,
               CASE WHEN (good AND k % 2 = 0) = (position % 2 = 0) THEN 'base' ELSE 'finetuned' END AS preference
        FROM details"""),
    "errors": (["kevents"], """
        SELECT example_id, k, CASE k % 6 WHEN 0 THEN 'rate_limit' WHEN 1 THEN 'daily_limit' WHEN 2 THEN 'rate_limit'
                      WHEN 3 THEN 'other' WHEN 4 THEN 'daily_limit' END AS kind,
               CASE k % 6 WHEN 0 THEN k * 60 + CAST('1' || k || '.5' AS DOUBLE) + 5
                          WHEN 1 THEN 3600 + k * 60 + 2 + 5 WHEN 2 THEN 5 END::DOUBLE AS wait_seconds
        FROM kevents"""),
    "cleaned_rows": (["dialogues"], f"""
        SELECT example_id, trim(regexp_replace(instruction, '[{fixed.WHITESPACE_CLASS}]+', ' ', 'g')) AS instruction,
               trim(regexp_replace(response, '[{fixed.WHITESPACE_CLASS}]+', ' ', 'g')) AS response,
               coalesce(regexp_matches(flags, '[BIK]'), false) AS has_quality_flag, intent
        FROM dialogues WHERE length(response) >= 20 AND length(instruction) >= 5"""),
    "cleaned": (["cleaned_rows"], """
        SELECT * FROM cleaned_rows
        QUALIFY row_number() OVER (PARTITION BY instruction, response ORDER BY example_id) = 1"""),
}


def sql(body: str, *views: str, extra: str = "") -> str:
    """``body`` with the views it needs, in order, as common table expressions."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in VIEWS[name][0]:
            need(other)
        if name not in order:
            order.append(name)

    for view in views:
        need(view)
    parts = [f"{name} AS ({VIEWS[name][1]})" for name in order]
    if extra:
        parts.append(extra.strip().rstrip(","))
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + body


def r(expression: str, name: str) -> str:
    return f"round({expression}, {DIGITS}) AS {name}"


# ---------------------------------------------------------------- n-gram scores

WORDS = f"[^{fixed.WHITESPACE_CLASS}]+"


def _rouge_tokens(column: str) -> str:
    return f"regexp_extract_all(lower({column}), '[a-z0-9]+')"


def _bleu_tokens(column: str) -> str:
    text = column
    for pattern, replacement in fixed.BLEU_13A_RULES:
        if pattern == "^|$":
            text = f"' ' || {text} || ' '"
        else:
            new = replacement.replace("$1", "\\1").replace("$2", "\\2")
            text = f"regexp_replace({text}, {_q(pattern)}, {_q(new)}, 'g')"
    return f"regexp_extract_all({text}, '{WORDS}')"


def _gram_ctes(source: str, key: str, tokens, orders: list[int]) -> str:
    """Tokens, grams by side, clipped matches per row and order, lengths per row."""
    grams = " UNION ALL ".join(
        f"SELECT {key}, {n} AS n, side, array_to_string(t[i:i + {n - 1}], ' ') AS gram "
        f"FROM (SELECT {key}, side, t, unnest(generate_series(1, len(t) - {n - 1})) AS i FROM sided WHERE len(t) >= {n})"
        for n in orders
    )
    return f"""
        toks AS (SELECT {key}, {tokens('prediction')} AS p, {tokens('response')} AS q FROM {source}),
        sided AS (SELECT {key}, 0 AS side, p AS t FROM toks UNION ALL SELECT {key}, 1, q FROM toks),
        grams AS ({grams}),
        counted AS (SELECT {key}, n, gram, count(*) FILTER (side = 0) AS cp, count(*) FILTER (side = 1) AS cq
                    FROM grams GROUP BY ALL),
        matched AS (SELECT {key}, n, sum(least(cp, cq)) AS m FROM counted GROUP BY ALL)"""


def _rouge_rows(n: int) -> str:
    total = f"(greatest(len(p) - {n - 1}, 0) + greatest(len(q) - {n - 1}, 0))"
    return (
        f"SELECT toks.example_id, CASE WHEN coalesce(m, 0) > 0 THEN 2.0::DOUBLE * m / {total} ELSE 0.0 END AS f "
        f"FROM toks LEFT JOIN matched ON matched.example_id = toks.example_id AND n = {n}"
    )


def _lcs_ctes(source: str, tag: str) -> str:
    """LCS by the usual table, one row of it per recursion step; ends in ``lcs_{tag}``. Words that both texts begin with belong to some LCS, so they need no table."""
    step = (
        "list_transform(range(1, len(q) + 1), lambda j: greatest(dp[j + 1], "
        "CASE WHEN q[j] = p[i + 1] THEN dp[j] + 1 ELSE 0 END))"
    )
    return f"""
        whole_words_{tag} AS (SELECT example_id, {_rouge_tokens('prediction')} AS p, {_rouge_tokens('response')} AS q FROM {source}),
        words_{tag} AS (SELECT example_id, p[k + 1:] AS p, q[k + 1:] AS q, k, len(p) + len(q) AS n
            FROM (SELECT *, coalesce(list_position(list_transform(range(1, least(len(p), len(q)) + 1), lambda j: p[j] = q[j]), false) - 1, least(len(p), len(q))) AS k
                  FROM whole_words_{tag})),
        dp_{tag} AS (
            SELECT example_id, p, q, k, n, 0 AS i, list_transform(range(0, len(q) + 1), lambda j: 0::BIGINT) AS dp FROM words_{tag}
            UNION ALL
            SELECT example_id, p, q, k, n, i + 1,
                   [0::BIGINT] || list_transform(range(1, len(q) + 1), lambda j: list_max(best[1:j]))
            FROM (SELECT *, {step} AS best FROM dp_{tag} WHERE i < len(p))),
        lcs_{tag} AS (SELECT example_id, CASE WHEN k + list_max(dp) > 0 THEN 2.0::DOUBLE * (k + list_max(dp)) / n ELSE 0.0 END AS f FROM dp_{tag} WHERE i = len(p))"""


def _lsum_ctes(source: str, tag: str) -> str:
    """The line-wise union LCS; ends in ``lsum_{tag}``.

    Lines that both sides have are found whole. Of the others, each pair of lines with a word in common gets the full table, one row of it per recursion step,
    and is then walked back from its end; reference words that the other line lacks are never taken and change no length, so they have no row.
    """
    def lines(column: str) -> str:
        return (
            f"SELECT example_id, l, {_rouge_tokens('line')} AS t FROM (SELECT example_id, unnest(string_split({column}, chr(10))) AS line, "
            f"generate_subscripts(string_split({column}, chr(10)), 1) AS l FROM {source}) WHERE line <> ''"
        )

    step = "list_transform(range(1, len(p) + 1), lambda j: greatest(last[j + 1], CASE WHEN p[j] = qs[i + 1] THEN last[j] + 1 ELSE 0 END))"
    return f"""
        ql_{tag} AS ({lines('response')}),
        pl_{tag} AS ({lines('prediction')}),
        same_{tag} AS (SELECT DISTINCT q.example_id, q.l FROM ql_{tag} q JOIN pl_{tag} p ON p.example_id = q.example_id AND p.t = q.t),
        rest_{tag} AS (SELECT * FROM ql_{tag} q ANTI JOIN same_{tag} s ON s.example_id = q.example_id AND s.l = q.l),
        met_{tag} AS (SELECT DISTINCT q.example_id, q.l, q.t AS q, p.t AS p FROM rest_{tag} q JOIN pl_{tag} p ON p.example_id = q.example_id AND list_has_any(q.t, p.t)),
        uniq_{tag} AS MATERIALIZED (SELECT row_number() OVER () AS id, q, p, qp, list_transform(qp, lambda k: q[k]) AS qs
            FROM (SELECT q, p, list_filter(range(1, len(q) + 1), lambda k: list_contains(p, q[k])) AS qp FROM (SELECT DISTINCT q, p FROM met_{tag}))),
        tab_{tag} AS (
            SELECT id, 0 AS i, list_transform(range(0, len(p) + 1), lambda j: 0::BIGINT) AS last FROM uniq_{tag} WHERE len(qp) > 1
            UNION ALL
            SELECT id, i + 1, [0::BIGINT] || list_transform(range(1, len(p) + 1), lambda j: greatest(list_max(tops[1:(j - 1) // 32]), list_max(best[(j - 1) // 32 * 32 + 1:j])))
            FROM (SELECT *, list_transform(range(0, (len(p) + 31) // 32), lambda b: list_max(best[b * 32 + 1:b * 32 + 32])) AS tops
                  FROM (SELECT t.id, t.i, u.p, {step} AS best FROM tab_{tag} t JOIN uniq_{tag} u ON u.id = t.id WHERE t.i < len(u.qs)))),
        whole_{tag} AS MATERIALIZED (SELECT id, list(last ORDER BY i) AS tab FROM tab_{tag} GROUP BY id),
        walk_{tag} AS (
            SELECT id, len(qs) AS i, len(p) AS j, 0::BIGINT AS taken FROM uniq_{tag} WHERE len(qp) > 1
            UNION ALL
            SELECT id, i - (hit OR NOT back)::INT, j - (hit OR back)::INT, CASE WHEN hit THEN i ELSE 0 END
            FROM (SELECT w.id, w.i, w.j, u.qs[w.i] = u.p[w.j] AS hit, h.tab[w.i + 1][w.j] > h.tab[w.i][w.j + 1] AS back
                  FROM walk_{tag} w JOIN uniq_{tag} u ON u.id = w.id JOIN whole_{tag} h ON h.id = w.id WHERE w.i > 0 AND w.j > 0)),
        found_{tag} AS (
            SELECT u.q, u.p, u.qp[w.taken] AS k FROM walk_{tag} w JOIN uniq_{tag} u ON u.id = w.id WHERE w.taken > 0
            UNION ALL SELECT q, p, qp[1] FROM uniq_{tag} WHERE len(qp) = 1),
        union_{tag} AS (
            SELECT DISTINCT m.example_id, m.l, f.k, m.q[f.k] AS word FROM met_{tag} m JOIN found_{tag} f ON f.q = m.q AND f.p = m.p
            UNION ALL SELECT q.example_id, q.l, unnest(range(1, len(q.t) + 1)), unnest(q.t) FROM ql_{tag} q JOIN same_{tag} s ON s.example_id = q.example_id AND s.l = q.l),
        side_{tag} AS (SELECT example_id, word, count(*) AS n FROM (SELECT example_id, unnest(t) AS word FROM pl_{tag}) GROUP BY ALL),
        hits_{tag} AS (SELECT u.example_id, sum(least(u.n, s.n)) AS hits FROM (SELECT example_id, word, count(*) AS n FROM union_{tag} GROUP BY ALL) u
                       JOIN side_{tag} s ON s.example_id = u.example_id AND s.word = u.word GROUP BY u.example_id),
        lsum_{tag} AS (SELECT x.example_id, CASE WHEN coalesce(hits, 0) > 0 THEN 2.0::DOUBLE * hits / (coalesce(np, 0) + coalesce(nq, 0)) ELSE 0.0 END AS f
            FROM {source} x LEFT JOIN hits_{tag} h ON h.example_id = x.example_id
            LEFT JOIN (SELECT example_id, sum(len(t)) AS np FROM pl_{tag} GROUP BY example_id) a ON a.example_id = x.example_id
            LEFT JOIN (SELECT example_id, sum(len(t)) AS nq FROM ql_{tag} GROUP BY example_id) b ON b.example_id = x.example_id)"""


def _rouge_value(source: str, n: int) -> str:
    """One mean score as a query of its own."""
    return sql(f"SELECT avg(f) AS f FROM ({_rouge_rows(n)})", source,
               extra=_gram_ctes(source, "example_id", _rouge_tokens, [n]))


def _bleu_sql(source: str, by: str | None) -> str:
    key = f"example_id, {by}" if by else "example_id"
    group = f"{by}, " if by else ""
    totals = ", ".join(f"sum(greatest(len(p) - {n - 1}, 0)) AS t{n}" for n in (1, 2, 3, 4))
    matches = ", ".join(f"coalesce(sum(m) FILTER (n = {n}), 0) AS m{n}" for n in (1, 2, 3, 4))
    logs = " + ".join(f"ln(CAST(m{n} AS DOUBLE) / t{n})" for n in (1, 2, 3, 4))
    grouping = f"GROUP BY {by}" if by else ""
    on = f"lens.{by} IS NOT DISTINCT FROM hits.{by}" if by else "true"
    return sql(
        f"""SELECT {f'lens.{by}, ' if by else ''}round(CASE WHEN m1 > 0 AND m2 > 0 AND m3 > 0 AND m4 > 0
              THEN exp(({logs}) / 4) * (CASE WHEN lp > lq THEN 1.0 ELSE exp(1 - CAST(lq AS DOUBLE) / lp) END)
              ELSE 0.0 END, {DIGITS}) AS bleu
            FROM lens JOIN hits ON {on}""",
        source,
        extra=_gram_ctes(source, key, _bleu_tokens, [1, 2, 3, 4]) + f""",
        lens AS (SELECT {group}{totals}, sum(len(p)) AS lp, sum(len(q)) AS lq FROM toks {grouping}),
        hits AS (SELECT {group}{matches} FROM matched {grouping})""",
    )


def _bleu_value(source: str, tag: str) -> str:
    """CTEs that end in ``bleu_{tag}`` with one value."""
    inner = _bleu_sql(source, None)
    return f"bleu_{tag} AS ({inner})"


def _simple_record(source: str, tag: str) -> str:
    return f"""rec_{tag} AS (
        SELECT (SELECT bleu FROM bleu_{tag}) AS bleu,
               avg(len(regexp_extract_all(prediction, '{WORDS}'))) AS avg_pred_length,
               avg(len(regexp_extract_all(response, '{WORDS}'))) AS avg_ref_length,
               avg(latency_ms) AS avg_latency_ms, quantile_cont(latency_ms, 0.95) AS p95_latency_ms
        FROM {source})"""


TWO_RECORDS = ",\n".join([
    _bleu_value("pred_base", "base"), _bleu_value("pred_ft", "ft"),
    _simple_record("pred_base", "base"), _simple_record("pred_ft", "ft"),
])

# ---------------------------------------------------------------- splits

KEY = "md5('{seed}:' || CAST({id} AS VARCHAR))"


def _key(column: str, seed: int = 42) -> str:
    return KEY.format(seed=seed, id=column)


QUOTAS = """
    sizes AS (SELECT intent, count(*) AS n FROM dialogues GROUP BY intent),
    t1 AS (SELECT sum(n) AS total, CAST(ceil(sum(n)::DOUBLE * 0.2::DOUBLE) AS BIGINT) AS seats FROM sizes),
    s1 AS (SELECT intent, n, n * seats // total AS base, n * seats % total AS rest, seats FROM sizes, t1),
    q1 AS (SELECT intent, n, base + (row_number() OVER (ORDER BY rest DESC, intent)
             <= seats - sum(base) OVER ())::BIGINT AS n_held_out FROM s1),
    t2 AS (SELECT sum(n_held_out) AS total, CAST(ceil(sum(n_held_out)::DOUBLE * 0.5::DOUBLE) AS BIGINT) AS seats FROM q1),
    s2 AS (SELECT intent, n, n_held_out, n_held_out * seats // total AS base,
                  n_held_out * seats % total AS rest, seats FROM q1, t2),
    quotas AS (SELECT intent, n, n_held_out, base + (row_number() OVER (ORDER BY rest DESC, intent)
             <= seats - sum(base) OVER ())::BIGINT AS n_test FROM s2)"""

# ---------------------------------------------------------------- support outcomes

MALFORMED = ("invalid_order_id", "order_not_found", "invalid_email", "account_not_found", "invalid_plan",
             "refund_not_positive", "unknown_action", "unknown_stored_plan")
SUCCESS = "CASE WHEN code = 'ok' THEN true WHEN code NOT IN (" + ", ".join(map(_q, MALFORMED)) + ") THEN false END"


def _say(key: str, *values: str) -> str:
    """A message as a SQL string with its places filled."""
    text = _q(fixed.MESSAGES[key])
    for i, value in enumerate(values):
        text = f"replace({text}, '{{{i}}}', {value})"
    return text


ORDER_ERRORS = (
    f"WHEN 'invalid_order_id' THEN {_say('invalid_order_id', 'order_id')} "
    "WHEN 'order_not_found' THEN 'Order not found: ' || order_id "
)
ACCOUNT_ERRORS = (
    f"WHEN 'invalid_email' THEN {_say('invalid_email', 'email')} "
    "WHEN 'account_not_found' THEN 'Account not found: ' || email "
)
STAMP = "'1998-01-31 09:30 UTC'"


def ok(expression: str, name: str) -> str:
    return f"CASE WHEN code = 'ok' THEN {expression} END AS {name}"


def _ordered(code: str, keep: str, errors: str, more: str) -> str:
    return sql(
        f"SELECT request_id, {keep}, {SUCCESS} AS success, code, CASE code {ORDER_ERRORS}{errors} END AS error, {more} FROM d",
        "with_order", extra=f"d AS (SELECT *, {code} AS code FROM with_order)",
    )


def _accounted(code: str, keep: str, errors: str, more: str) -> str:
    return sql(
        f"SELECT request_id, {keep}, {SUCCESS} AS success, code, CASE code {ACCOUNT_ERRORS}{errors} END AS error, {more} FROM d",
        "with_account", extra=f"d AS (SELECT *, {code} AS code FROM with_account)",
    )


SHIPPED = "status IN ('shipped', 'out_for_delivery', 'delivered')"
AGO = "date_diff('day', delivered, DATE '1998-01-31')"
ADDRESS_CODE = f"CASE WHEN bad_order IS NOT NULL THEN bad_order WHEN {SHIPPED} THEN 'already_shipped' ELSE 'ok' END"
CANCEL_CODE = (
    f"CASE WHEN bad_order IS NOT NULL THEN bad_order WHEN {SHIPPED} THEN 'already_shipped' "
    "WHEN status = 'cancelled' THEN 'already_cancelled' ELSE 'ok' END"
)
RETURN_CODE = (
    "CASE WHEN bad_order IS NOT NULL THEN bad_order WHEN status <> 'delivered' THEN 'not_delivered' "
    f"WHEN {AGO} > 30 THEN 'window_expired' ELSE 'ok' END"
)
UNLOCK_CODE = (
    "CASE WHEN bad_account IS NOT NULL THEN bad_account WHEN account_status = 'cancelled' THEN 'account_cancelled' ELSE 'ok' END"
)
PLAN_CODE = (
    "CASE WHEN new_plan NOT IN ('Basic', 'Standard', 'Premium') THEN 'invalid_plan' "
    "WHEN bad_account IS NOT NULL THEN bad_account "
    "WHEN account_status IN ('suspended', 'cancelled') THEN 'account_blocked' "
    "WHEN subscription_plan NOT IN ('Basic', 'Standard', 'Premium') THEN 'unknown_stored_plan' "
    "WHEN subscription_plan = new_plan THEN 'same_plan' ELSE 'ok' END"
)
SUBSCRIPTION_CODE = (
    "CASE WHEN bad_account IS NOT NULL THEN bad_account WHEN account_status = 'cancelled' THEN 'already_cancelled' ELSE 'ok' END"
)
REFUND_CODE = (
    "CASE WHEN amount IS NULL OR amount <= 0 THEN 'refund_not_positive' WHEN amount > 500 THEN 'escalated' "
    "WHEN bad_account IS NOT NULL THEN bad_account ELSE 'ok' END"
)
PRICE = "CAST(CASE {0} WHEN 'Basic' THEN 9.99 WHEN 'Standard' THEN 19.99 WHEN 'Premium' THEN 39.99 END AS DECIMAL(10,2))"
OLD, NEW = PRICE.format("subscription_plan"), PRICE.format("new_plan")
MONEY = "printf('%.2f', amount)"
REFUND_NUMBER = "('0x' || substr(md5(order_id || email), 1, 8))::BIGINT % 1000000"

DECIDED = f"""
    both_sides AS (SELECT o.*, a.account_status, a.subscription_plan, a.bad_account, a.member_since, a.total_orders, a.loyalty_points,
                          a.payment_method, a.billing_cycle, a.next_billing_date
                   FROM with_order o JOIN with_account a ON a.request_id = o.request_id),
    decided AS (SELECT *, CASE action
        WHEN 'lookup_order' THEN coalesce(bad_order, 'ok')
        WHEN 'update_shipping_address' THEN {ADDRESS_CODE}
        WHEN 'cancel_order' THEN {CANCEL_CODE}
        WHEN 'get_return_label' THEN {RETURN_CODE}
        WHEN 'get_account_info' THEN coalesce(bad_account, 'ok')
        WHEN 'unlock_account' THEN {UNLOCK_CODE}
        WHEN 'update_subscription' THEN {PLAN_CODE}
        WHEN 'cancel_subscription' THEN {SUBSCRIPTION_CODE}
        WHEN 'process_refund' THEN {REFUND_CODE}
        ELSE 'unknown_action' END AS code FROM both_sides),
    outcomes AS (SELECT *, CASE WHEN code = 'ok' AND action = 'cancel_order' THEN CAST(total AS DECIMAL(18,2))
                                WHEN code = 'ok' AND action = 'process_refund' THEN CAST(amount AS DECIMAL(18,2))
                           END AS refund_amount FROM decided)"""

# ---------------------------------------------------------------- answers of tools


def _js(expression: str) -> str:
    """A text as JSON: the data have no control characters but line feeds, and the messages one dash beyond ASCII."""
    for old, new in (("chr(92)", "chr(92) || chr(92)"), ("'\"'", "chr(92) || '\"'"), ("chr(10)", "chr(92) || 'n'"), ("'—'", "chr(92) || 'u2014'")):
        expression = f"replace({expression}, {old}, {new})"
    return f"'\"' || {expression} || '\"'"


def _object(fields: dict[str, str]) -> str:
    lines = ", ".join(f"'  \"{name}\": ' || {value}" for name, value in fields.items())
    return f"'{{' || chr(10) || concat_ws(',' || chr(10), {lines}) || chr(10) || '}}'"


def _told(errors: str, accepted: dict[str, str], refused: dict[str, str] = {}) -> str:
    no = f"CASE WHEN NOT {SUCCESS} THEN 'false' END"
    return f"CASE WHEN code = 'ok' THEN {_object(accepted)} ELSE {_object({'success': no, 'error': _js(f'CASE code {errors} END'), **refused})} END"


def _cents(expression: str) -> str:
    return f"printf('%.2f', {expression})"


_DATE = "'\"' || CAST({0} AS VARCHAR) || '\"'"
_DONE = {"success": "'true'"}
_REASON = "coalesce({0}, 'null')".format(_js("CASE WHEN action = 'process_refund' OR request_id % 3 = 0 THEN reason END"))
ADDRESS_ERRORS = f"{ORDER_ERRORS} WHEN 'already_shipped' THEN {_say('address_already_shipped', 'status')}"
CANCEL_ERRORS = f"{ORDER_ERRORS} WHEN 'already_shipped' THEN {_say('cancel_already_shipped', 'status')} WHEN 'already_cancelled' THEN {_say('already_cancelled')}"
RETURN_ERRORS = (
    f"{ORDER_ERRORS} WHEN 'not_delivered' THEN {_say('not_delivered', 'status')} "
    f"WHEN 'window_expired' THEN {_say('window_expired', f'CAST({AGO} AS VARCHAR)')}"
)
UNLOCK_ERRORS = f"{ACCOUNT_ERRORS} WHEN 'account_cancelled' THEN {_say('unlock_cancelled')}"
PLAN_ERRORS = (
    f"{ACCOUNT_ERRORS} WHEN 'invalid_plan' THEN {_say('invalid_plan', 'new_plan')} "
    f"WHEN 'account_blocked' THEN {_say('plan_blocked', 'account_status')} WHEN 'same_plan' THEN {_say('same_plan', 'new_plan')} "
    "WHEN 'unknown_stored_plan' THEN 'Unknown plan on the account: ' || subscription_plan "
)
SUBSCRIPTION_ERRORS = f"{ACCOUNT_ERRORS} WHEN 'already_cancelled' THEN {_say('subscription_already_cancelled')}"
REFUND_ERRORS = f"{ACCOUNT_ERRORS} WHEN 'refund_not_positive' THEN {_say('refund_not_positive')} WHEN 'escalated' THEN {_say('refund_escalated', MONEY)}"
PLAN_TERMS = {
    "old_plan": "subscription_plan", "new_plan": "new_plan", "old_price": f"'$' || {OLD} || '/month'", "new_price": f"'$' || {NEW} || '/month'",
    "effective_date": f"CASE WHEN {NEW} > {OLD} THEN 'immediately' ELSE 'next billing cycle' END",
    "proration_credit": f"CASE WHEN {NEW} > {OLD} THEN '$' || ({NEW} - {OLD}) ELSE 'N/A' END",
    "message": f"CASE WHEN {NEW} > {OLD} THEN {_say('plan_upgraded', 'subscription_plan', 'new_plan')} ELSE {_say('plan_downgraded', 'subscription_plan', 'new_plan')} END",
}
_ITEMS = (
    """'[' || chr(10) || '    {' || chr(10) || '      "name": ' || """ + _js("item") + """ || ',' || chr(10) || '      "quantity": 1,' || chr(10) || '      "price": ' || """
    + _cents("total") + """ || chr(10) || '    }' || chr(10) || '  ]'"""
)
ANSWERS = {
    "lookup_order": _told(ORDER_ERRORS, {
        "order_id": _js("order_id"), "status": _js("status"), "order_date": _DATE.format("order_date"), "estimated_delivery": _DATE.format("estimated_delivery"),
        "carrier": _js("carrier"), "tracking_number": _js("tracking_number"), "items": _ITEMS, "total": _cents("total"), "shipping_address": _js("shipping_address"),
        "delivered_date": "CASE WHEN status = 'delivered' THEN " + _DATE.format("delivered") + " END",
    }),
    "update_shipping_address": _told(ADDRESS_ERRORS, {
        **_DONE, "order_id": _js("order_id"), "old_address": _js("shipping_address"), "new_address": _js("new_address"), "message": _js(_say("address_ok")),
    }, {"carrier": f"CASE WHEN code = 'already_shipped' THEN {_js('carrier')} END", "tracking_number": f"CASE WHEN code = 'already_shipped' THEN {_js('tracking_number')} END"}),
    "cancel_order": _told(CANCEL_ERRORS, {
        **_DONE, "order_id": _js("order_id"), "cancelled_at": _js(STAMP), "refund_amount": _cents("total"), "refund_method": _js(_q(fixed.ORDER_REFUND_METHOD)),
        "refund_eta": _js(_q(fixed.REFUND_ETA)), "reason": _REASON,
    }),
    "get_return_label": _told(RETURN_ERRORS, {
        **_DONE, "order_id": _js("order_id"), "item": _js("item_name"), "return_reason": _js("return_reason"), "return_label_url": _js(_q(fixed.RETURN_LABEL_URL) + " || order_id"),
        "return_instructions": _js(_q(fixed.RETURN_INSTRUCTIONS)), "refund_eta": _js(_q(fixed.RETURN_REFUND_ETA)), "carrier": _js(_q(fixed.RETURN_CARRIER)),
    }),
    "get_account_info": _told(ACCOUNT_ERRORS, {
        "email": _js("email"), "account_status": _js("account_status"), "subscription_plan": _js("subscription_plan"), "member_since": _DATE.format("member_since"),
        "total_orders": "total_orders", "loyalty_points": "loyalty_points", "payment_method": _js("payment_method"), "billing_cycle": _js("billing_cycle"),
        "next_billing_date": _DATE.format("next_billing_date"),
    }),
    "unlock_account": _told(UNLOCK_ERRORS, {
        **_DONE, "email": _js("email"), "message": _js(_say("unlock_ok")), "action_taken": _js(_q(fixed.UNLOCK_ACTION)), "timestamp": _js(STAMP),
    }),
    "update_subscription": _told(PLAN_ERRORS, {**_DONE, "email": _js("email"), **{name: _js(value) for name, value in PLAN_TERMS.items()}}),
    "cancel_subscription": _told(SUBSCRIPTION_ERRORS, {
        **_DONE, "email": _js("email"), "cancellation_date": _js("'1998-01-31'"), "access_until": _DATE.format("next_billing_date"), "reason": _REASON,
        "message": _js(_say("subscription_cancelled", "CAST(next_billing_date AS VARCHAR)")), "reactivation_info": _js(_q(fixed.REACTIVATION_INFO)),
    }),
    "process_refund": _told(REFUND_ERRORS, {
        **_DONE, "refund_id": _js(f"'REF-' || lpad(CAST({REFUND_NUMBER} AS VARCHAR), 6, '0')"), "order_id": _js("order_id"), "email": _js("email"),
        "amount": _js(f"'$' || {MONEY}"), "method": _js("payment_method"), "reason": _REASON, "eta": _js(_q(fixed.REFUND_ETA)), "timestamp": _js(STAMP),
        "message": _js(_say("refund_ok", MONEY, "payment_method")),
    }, {"escalated": "CASE WHEN code = 'escalated' THEN 'true' END"}),
}
TOLD = DECIDED + f""",
    told AS (SELECT t.request_id, t.tool, t.text AS response, CASE WHEN t.call_code = 'ok' THEN o.code ELSE t.call_code END AS code,
                    CASE t.call_code WHEN 'unknown_tool' THEN '{{"error": "Unknown tool: ' || t.tool || '"}}'
                         WHEN 'bad_arguments' THEN '{{"error": "Tool call failed"}}' ELSE o.answer END AS tool_result
             FROM agent_texts t JOIN (SELECT *, CASE action {' '.join(f"WHEN '{tool}' THEN {text}" for tool, text in ANSWERS.items())} END AS answer FROM outcomes) o
               ON o.request_id = t.request_id
             WHERE t.tool IS NOT NULL)"""

# ---------------------------------------------------------------- prompts

SYSTEM = _q(fixed.SYSTEM_PROMPT)
AGENT_SYSTEM = _q(fixed.AGENT_SYSTEM_PROMPT.replace("{tool_list}", ", ".join(fixed.TOOL_CATALOGUE)))
TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def _head(role: str) -> str:
    return f"'<|start_header_id|>{role}<|end_header_id|>' || chr(10) || chr(10)"


def _turn(role: str, content: str) -> str:
    return f"{_head(role)} || {TRIM.format(content)} || '<|eot_id|>'"


CHAT_OPEN = f"'<|begin_of_text|>' || {_turn('system', SYSTEM)} || {_turn('user', 'instruction')} || {_head('assistant')}"
CHAT = f"'<|begin_of_text|>' || {_turn('system', SYSTEM)} || {_turn('user', 'instruction')} || {_turn('assistant', 'response')}"


def _filled(template: str, **values: str) -> str:
    """A prompt as concatenated SQL strings, so that values are never searched."""
    parts = [template]
    for name, value in values.items():
        parts = [
            piece
            for part in parts
            for i, text in enumerate(part.split("{" + name + "}") if isinstance(part, str) else [part])
            for piece in (([(value,)] if i else []) + [text])
        ]
    return " || ".join(p[0] if isinstance(p, tuple) else _q(p) for p in parts if p != "")


RATES = "avg(CASE WHEN preference = 'finetuned' THEN 1.0::DOUBLE ELSE 0.0 END)"
VERDICTS = """
    verdicts AS (SELECT *, CASE WHEN coalesce(winner = 'A', false) = (example_id % 2 = 0)
                           THEN 'base' ELSE 'finetuned' END AS preference FROM rating)"""

GREEDY = f"""
    v AS (SELECT vec_id // 32 AS pair_id, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    sims AS (SELECT a.pair_id, a.vec_id AS c, b.vec_id AS q, list_cosine_similarity(a.e, b.e) AS s
             FROM v a JOIN v b ON a.pair_id = b.pair_id AND a.vec_id % 2 = 0 AND b.vec_id % 2 = 1),
    prec AS (SELECT pair_id, avg(s) AS p FROM (SELECT pair_id, c, max(s) AS s FROM sims GROUP BY ALL) GROUP BY pair_id),
    rec AS (SELECT pair_id, avg(s) AS q FROM (SELECT pair_id, q, max(s) AS s FROM sims GROUP BY ALL) GROUP BY pair_id),
    greedy AS (SELECT prec.pair_id, p AS precision, q AS recall, 2 * p * q / (p + q) AS f1
               FROM prec JOIN rec ON prec.pair_id = rec.pair_id)"""

HISTORY_STEPS = TOLD + """,
    stored AS (SELECT conv_id, turn, role, text AS content FROM conversations),
    ends AS (SELECT conv_id, max(turn) AS last FROM stored GROUP BY conv_id),
    history AS (
        SELECT conv_id, -1 AS turn, 'system' AS role, %s AS content FROM ends
        UNION ALL SELECT * FROM stored
        UNION ALL SELECT conv_id, last + 1, 'assistant', response FROM told JOIN ends ON conv_id = request_id
        UNION ALL SELECT conv_id, last + 2, 'user', 'Tool result:' || chr(10) || tool_result || chr(10) || chr(10)
               || 'Please respond to the customer based on this information.'
        FROM told JOIN ends ON conv_id = request_id)""" % AGENT_SYSTEM


def _delta_rows(names: list[str], left: str, right: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{m}' AS metric, (SELECT {m} FROM {left}) AS b, (SELECT {m} FROM {right}) AS c" for m in names
    )


def _scored_rows(source: str, n: int) -> str:
    return sql(f"SELECT example_id, f FROM ({_rouge_rows(n)})", source, extra=_gram_ctes(source, "example_id", _rouge_tokens, [n]))


def _record(source: str, tag: str, by: str | None) -> str:
    """The CTEs of a whole metrics record, one row or one per ``by``; ends in ``full_{tag}``, not rounded."""
    bleu = _bleu_sql(source, by).replace(f", {DIGITS}) AS bleu", ", 15) AS bleu")
    group, key = (f"GROUP BY x.{by}", f"x.{by}, ") if by else ("", "")
    return ",".join([_lcs_ctes(source, tag), _lsum_ctes(source, tag)]) + f""",
        bleu_all_{tag} AS ({bleu}),
        full_{tag} AS (
            SELECT {key}count(*) AS n_samples, (SELECT any_value(bleu) FROM bleu_all_{tag} b {f'WHERE b.{by} = x.{by}' if by else ''}) AS bleu,
                   avg(r1.f) AS rouge1, avg(r2.f) AS rouge2, avg(l.f) AS "rougeL", avg(u.f) AS "rougeLsum",
                   avg(len(regexp_extract_all(prediction, '{WORDS}'))) AS avg_pred_length, avg(len(regexp_extract_all(response, '{WORDS}'))) AS avg_ref_length,
                   avg(latency_ms) AS avg_latency_ms, quantile_cont(latency_ms, 0.95) AS p95_latency_ms
            FROM {source} x JOIN ({_scored_rows(source, 1)}) r1 ON r1.example_id = x.example_id JOIN ({_scored_rows(source, 2)}) r2 ON r2.example_id = x.example_id
            JOIN lcs_{tag} l ON l.example_id = x.example_id JOIN lsum_{tag} u ON u.example_id = x.example_id {group})"""


RECORD_COLUMNS = ["bleu", "rouge1", "rouge2", '"rougeL"', '"rougeLsum"', "avg_pred_length", "avg_ref_length", "avg_latency_ms", "p95_latency_ms"]
FULL = ", ".join(f"round({c}, {DIGITS}) AS {c}" for c in RECORD_COLUMNS) + f", {r('avg_pred_length / greatest(avg_ref_length, 1)', 'length_ratio')}"
LABELS = "['click', 'error', 'purchase', 'signup', 'view']"
BOARD = f"""
    {_record("runs", "runs", "run").strip()},
    losses AS (SELECT label, exp(avg(latency_ms / 100)) AS perplexity FROM latency GROUP BY label), {GREEDY.strip()},
    matched_runs AS (SELECT {LABELS}[pair_id % 5 + 1] AS label, avg(f1) AS bertscore_f1 FROM greedy GROUP BY ALL),
    made AS (SELECT {LABELS}[r_regionkey % 5 + 1] AS label, r_name AS base_model, CAST(4 * 2 ** r_regionkey AS BIGINT) AS rank, 'q_proj' AS first_module,
                    CASE WHEN r_regionkey <> 3 THEN round(0.0002::DOUBLE / (r_regionkey + 1), 6) END AS learning_rate FROM region),
    board AS (SELECT coalesce(f.run, j.label) AS label, perplexity, f."rougeL", f.bleu, bertscore_f1, f.avg_latency_ms, avg_composite, base_model, rank, first_module, learning_rate
              FROM full_runs f FULL JOIN judged j ON j.label = f.run LEFT JOIN losses l ON l.label = f.run LEFT JOIN matched_runs m ON m.label = f.run
              LEFT JOIN made a ON a.label = coalesce(f.run, j.label))"""


ORACLES: dict[str, str] = {
    "scan_table": "SELECT doc_id, lang, source, n_chars FROM documents",
    "profile_basic": sql(
        f"""SELECT count(*) AS n_rows, 6::BIGINT AS n_columns, count(DISTINCT intent) AS n_intent,
                   count(DISTINCT category) AS n_category, {r('avg(length(instruction))', 'avg_instruction_len')},
                   {r('avg(length(response))', 'avg_response_len')} FROM dialogues""", "dialogues"),
    "profile_record": sql(
        f"""SELECT count(*) AS n_rows, 6::BIGINT AS n_columns, count(DISTINCT intent) AS n_intent,
                   count(DISTINCT category) AS n_category, {r('avg(length(instruction))', 'avg_instruction_len')},
                   {r('avg(length(response))', 'avg_response_len')}, count(*) FILTER (flags IS NULL) AS null_flags,
                   array_to_string(list_filter([CASE WHEN count(DISTINCT intent) <= 1 THEN 'intent' END,
                     CASE WHEN count(DISTINCT category) <= 1 THEN 'category' END,
                     CASE WHEN count(DISTINCT flags) <= 1 THEN 'flags' END], lambda x: x IS NOT NULL), ',') AS constant_columns,
                   (SELECT string_agg(c || '=' || n, ',' ORDER BY c) FROM
                     (SELECT c, count(*) AS n FROM (SELECT unnest(string_split(flags, '')) AS c FROM dialogues)
                      WHERE c <> '' GROUP BY c)) AS flag_distribution
            FROM dialogues""", "dialogues"),
    "null_counts": sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null FROM dialogues"
            for c in ("example_id", "instruction", "response", "intent", "category", "flags")), "dialogues"),
    "value_counts_topk": sql(
        f"""SELECT intent AS value, count(*) AS n,
                   {r('count(*) * 100.0::DOUBLE / (SELECT count(intent) FROM dialogues)', 'share_pct')}
            FROM dialogues WHERE intent IS NOT NULL GROUP BY intent ORDER BY n DESC, value LIMIT 10""", "dialogues"),
    "value_counts_all": sql(
        f"""SELECT category AS value, count(*) AS n,
                   {r('count(*) * 100.0::DOUBLE / (SELECT count(category) FROM dialogues)', 'share_pct')}
            FROM dialogues WHERE category IS NOT NULL GROUP BY category""", "dialogues"),
    "flag_chars": sql(
        """SELECT c AS flag, count(*) AS n FROM (SELECT unnest(string_split(flags, '')) AS c FROM dialogues)
           WHERE c <> '' GROUP BY c""", "dialogues"),
    "length_histogram": sql(
        f"""SELECT b AS bin, {r('lo + b * (hi - lo) / 50.0::DOUBLE', 'low')},
                   {r('lo + (b + 1) * (hi - lo) / 50.0::DOUBLE', 'high')}, count(len) AS n
            FROM (SELECT unnest(generate_series(0, 49)) AS b) bins, lim
            LEFT JOIN lens ON least((len - lo) * 50 // (hi - lo), 49) = b GROUP BY b, lo, hi""", "dialogues",
        extra="""lens AS (SELECT length(response)::BIGINT AS len FROM dialogues),
                 lim AS (SELECT min(len) AS lo, max(len) AS hi FROM lens)"""),
    "dimension_values": sql("SELECT DISTINCT intent FROM dialogues WHERE intent IS NOT NULL", "dialogues"),

    "drop_missing": sql("SELECT example_id, flags FROM dialogues WHERE flags IS NOT NULL", "dialogues"),
    "min_length": sql(
        """SELECT example_id, length(response)::BIGINT AS response_chars FROM dialogues
           WHERE length(response) >= 20 AND length(instruction) >= 5""", "dialogues"),
    "normalize_ws": sql(
        f"""SELECT example_id, trim(regexp_replace(instruction, '[{fixed.WHITESPACE_CLASS}]+', ' ', 'g')) AS instruction,
                   trim(regexp_replace(response, '[{fixed.WHITESPACE_CLASS}]+', ' ', 'g')) AS response FROM pairs""", "pairs"),
    "quality_flag": sql(
        "SELECT example_id, flags, coalesce(regexp_matches(flags, '[BIK]'), false) AS has_quality_flag FROM dialogues",
        "dialogues"),
    "dedup_first": sql(
        """SELECT example_id, intent, category, flags FROM dialogues
           QUALIFY row_number() OVER (PARTITION BY instruction, response ORDER BY example_id) = 1""", "dialogues"),
    "with_position": sql(
        "SELECT example_id, row_number() OVER (ORDER BY example_id) - 1 AS position FROM pairs", "pairs"),
    "clean_audit": sql(
        f"""SELECT rows_in, after_missing, after_length, flagged, after_dedup, rows_in - after_dedup AS removed,
                   {r('(rows_in - after_dedup) * 100.0::DOUBLE / rows_in', 'removed_pct')}
            FROM (SELECT (SELECT count(*) FROM dialogues) AS rows_in,
                         (SELECT count(*) FROM dialogues WHERE instruction IS NOT NULL AND response IS NOT NULL) AS after_missing,
                         (SELECT count(*) FROM cleaned_rows) AS after_length,
                         (SELECT count(*) FROM cleaned_rows WHERE has_quality_flag) AS flagged,
                         (SELECT count(*) FROM cleaned) AS after_dedup)""", "cleaned"),
    "clean_pipeline": sql("SELECT example_id, instruction, response, has_quality_flag, intent FROM cleaned", "cleaned"),
    "clean_without_flags": sql(
        """SELECT * FROM tidy WHERE length(response) >= 20 AND length(instruction) >= 5
           QUALIFY row_number() OVER (PARTITION BY instruction, response ORDER BY example_id) = 1""", "pairs",
        extra=f"""tidy AS (
            SELECT example_id, trim(regexp_replace(instruction, '[{fixed.WHITESPACE_CLASS}]+', ' ', 'g')) AS instruction,
                   trim(regexp_replace(response, '[{fixed.WHITESPACE_CLASS}]+', ' ', 'g')) AS response
            FROM pairs WHERE length(response) >= 20 AND length(instruction) >= 5)"""),
    "select_columns": sql("SELECT instruction, response, intent, category FROM pred_base", "pred_base"),
    "pick_example": sql(
        f"""SELECT example_id, instruction, '**Intent:** `' || intent || '`  ·  **Category:** `' || category || '`' AS label
            FROM pairs WHERE intent = 'intent_3' ORDER BY {_key('example_id')}, example_id LIMIT 1""", "pairs"),

    "pairs_from_turns": sql("SELECT conv_id, turn, instruction, response FROM pairs", "pairs"),
    "assemble_history": sql(
        """SELECT conv_id, count(*) AS n_messages,
                  string_agg(role || '=' || content, '|' ORDER BY turn) AS messages FROM history GROUP BY conv_id""",
        "agent_texts", "with_order", "with_account", extra=HISTORY_STEPS),
    "history_turns": sql(
        "SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, content FROM history", "agent_texts", "with_order", "with_account", extra=HISTORY_STEPS),
    "render_transcript":
        """SELECT conv_id, 'SYSTEM: Be brief.' || chr(10) ||
                  string_agg(upper(role) || ': ' || text, chr(10) ORDER BY turn) || chr(10) || 'ASSISTANT:' AS transcript
           FROM conversations GROUP BY conv_id""",
    "to_messages": sql(
        f"""SELECT example_id, intent, category, 'system' AS role_0, 'user' AS role_1, 'assistant' AS role_2,
                   {SYSTEM} AS content_0, instruction AS content_1, response AS content_2 FROM pairs""", "pairs"),
    "render_chat": sql(f"SELECT example_id, {CHAT} AS text FROM pairs", "pairs"),
    "render_prompt": sql(
        f"""SELECT example_id, {SYSTEM} || chr(10) || chr(10) || 'User: ' || instruction || chr(10) || 'Assistant:' AS plain,
                   'System: ' || {SYSTEM} || chr(10) || 'User: ' || instruction || chr(10) || 'Assistant:' AS labelled,
                   {CHAT_OPEN} AS chat FROM pairs""", "pairs"),
    "render_pair": sql(
        "SELECT example_id, 'User: ' || instruction || chr(10) || 'Assistant: ' || response AS text FROM pairs", "pairs"),

    "split_quotas": sql("SELECT intent, n, n_held_out::BIGINT AS n_held_out, n_test::BIGINT AS n_test FROM quotas",
                        "dialogues", extra=QUOTAS),
    "stratified_split": sql(
        """SELECT example_id, ranked.intent, CASE WHEN rk <= n_test THEN 'test' WHEN rk <= n_held_out THEN 'validation'
                  ELSE 'train' END AS split FROM ranked JOIN quotas ON quotas.intent = ranked.intent""", "dialogues",
        extra=QUOTAS + f""", ranked AS (SELECT example_id, intent, row_number() OVER (
                PARTITION BY intent ORDER BY {_key('example_id')}, example_id) AS rk FROM dialogues)"""),
    "split_by_hash": sql(
        """SELECT example_id, CASE WHEN share >= 0.2::DOUBLE THEN 'train' WHEN share >= 0.1::DOUBLE THEN 'validation'
                  ELSE 'test' END AS split FROM shares""", "dialogues",
        extra=f"""shares AS (SELECT example_id,
            CAST(('0x' || substr({_key('example_id')}, 1, 12))::BIGINT AS DOUBLE) / {16**12}::DOUBLE AS share FROM dialogues)"""),
    "sample_n": sql(
        f"SELECT example_id, prediction FROM pred_base ORDER BY {_key('example_id')}, example_id LIMIT 100", "pred_base"),
    "sample_n_ranked":
        f"SELECT event_id, event_type FROM events ORDER BY {_key('event_id', 7)}, event_id LIMIT 10001",
    "sample_aligned": sql(
        """SELECT s.example_id, s.instruction, s.prediction AS prediction_base, f.prediction AS prediction_ft
           FROM s JOIN pred_ft f ON f.example_id = s.example_id""", "pred_base", "pred_ft",
        extra=f"s AS (SELECT * FROM pred_base ORDER BY {_key('example_id')}, example_id LIMIT 50)"),
    "sample_per_group": sql(
        f"""SELECT example_id, intent FROM dialogues
            QUALIFY row_number() OVER (PARTITION BY intent ORDER BY {_key('example_id')}, example_id) <= 2""", "dialogues"),
    "head_n": sql("SELECT example_id, instruction FROM pairs ORDER BY example_id LIMIT 50", "pairs"),

    "rouge_1": sql(f"SELECT {r('avg(f)', 'rouge1')} FROM ({_rouge_rows(1)})", "pred_ft",
                   extra=_gram_ctes("pred_ft", "example_id", _rouge_tokens, [1])),
    "rouge_2": sql(f"SELECT {r('avg(f)', 'rouge2')} FROM ({_rouge_rows(2)})", "pred_ft",
                   extra=_gram_ctes("pred_ft", "example_id", _rouge_tokens, [2])),
    "rouge_rows": sql(
        f"""SELECT a.example_id, {r('a.f', 'rouge1')}, {r('b.f', 'rouge2')}
            FROM ({_rouge_rows(1)}) a JOIN ({_rouge_rows(2)}) b ON a.example_id = b.example_id""", "pred_base",
        extra=_gram_ctes("pred_base", "example_id", _rouge_tokens, [1, 2])),
    "rouge_l": sql(f"SELECT {r('avg(f)', 'rougeL')} FROM lcs_base", "pred_base", extra=_lcs_ctes("pred_base", "base")),
    "rouge_lsum": sql(f"SELECT {r('avg(f)', 'rougeLsum')} FROM lsum_base", "pred_base", extra=_lsum_ctes("pred_base", "base")),
    "metrics_for": sql(f"SELECT 'base' AS label, 'models/base' AS model_path, n_samples, {FULL} FROM full_base", "pred_base", extra=_record("pred_base", "base", None)),
    "metrics_by_slice": sql(
        f"SELECT category, 'base' AS label, 'models/base' AS model_path, n_samples, {FULL} FROM full_base", "pred_base", extra=_record("pred_base", "base", "category")),
    "compare_full": sql(
        f"""SELECT metric, {r('b', 'base')}, {r('c', 'candidate')}, {r('c - b', 'delta')},
                   round(CASE WHEN b <> 0 THEN (c - b) / b * 100 ELSE 0 END, {DIGITS}) AS pct,
                   CASE WHEN c = b THEN 'same' WHEN (c > b) = (metric NOT LIKE 'avg%') THEN 'better' ELSE 'worse' END AS verdict
            FROM ({_delta_rows(['bleu', 'avg_pred_length', 'avg_latency_ms'], 'rec_base', 'rec_ft')}
                  UNION ALL SELECT 'rougeL', (SELECT avg(f) FROM lcs_base), (SELECT avg(f) FROM lcs_ft)
                  UNION ALL SELECT 'rouge1', ({_rouge_value('pred_base', 1)}), ({_rouge_value('pred_ft', 1)})
                  UNION ALL SELECT 'rouge2', ({_rouge_value('pred_base', 2)}), ({_rouge_value('pred_ft', 2)}))""",
        "pred_base", "pred_ft", extra=",\n".join([
            TWO_RECORDS.replace(f", {DIGITS}) AS bleu", ", 15) AS bleu"),
            _lcs_ctes("pred_base", "base"), _lcs_ctes("pred_ft", "ft"),
        ])),
    "bleu": _bleu_sql("pred_ft", None),
    "bleu_by_intent": _bleu_sql("pred_ft", "intent"),
    "bleu_documents": _bleu_sql("doc_predictions", "category"),
    "length_stats": sql(
        f"""SELECT category, {r('p', 'avg_pred_length')}, {r('q', 'avg_ref_length')}, {r('p / greatest(q, 1)', 'length_ratio')}
            FROM (SELECT category, avg(len(regexp_extract_all(prediction, '{WORDS}'))) AS p,
                         avg(len(regexp_extract_all(response, '{WORDS}'))) AS q FROM pred_base GROUP BY category)""",
        "pred_base"),
    "latency_stats": sql(
        f"SELECT {r('avg(latency_ms)', 'avg_latency_ms')}, {r('quantile_cont(latency_ms, 0.95)', 'p95_latency_ms')} FROM latency", "latency"),
    "latency_stats_by_label": sql(
        f"""SELECT label, {r('avg(latency_ms)', 'avg_latency_ms')}, {r('quantile_cont(latency_ms, 0.95)', 'p95_latency_ms')}
            FROM latency GROUP BY label""", "latency"),
    "latency_summary": sql(
        f"""SELECT label, count(*) AS n_prompts, {r('avg(latency_ms)', 'avg_latency_ms')},
                   {r('min(latency_ms)', 'min_latency_ms')}, {r('max(latency_ms)', 'max_latency_ms')},
                   {r('avg(response_tokens / (nullif(latency_ms, 0) / 1000.0::DOUBLE))', 'avg_tokens_per_sec')},
                   {r('avg(response_tokens)', 'avg_response_tokens')}, {r('median(latency_ms)', 'median_latency_ms')},
                   {r('list_sort(list(latency_ms) FILTER (latency_ms IS NOT NULL))[CAST(floor(0.95::DOUBLE * count(latency_ms)) AS BIGINT) + 1]', 'p95_latency_ms')}
            FROM latency GROUP BY label""", "latency"),
    "latency_details": sql(
        """SELECT event_id, prompt, label AS response, round(latency_ms, 1) AS latency_ms, response_tokens
           FROM latency""", "latency"),
    "perplexity": sql(f"SELECT label, {r('exp(avg(latency_ms / 100))', 'perplexity')} FROM latency GROUP BY label", "latency"),
    "perplexity_weighted": sql(
        f"""SELECT label, {r('exp(sum(latency_ms / 100 * response_tokens) / sum(response_tokens) FILTER (latency_ms IS NOT NULL))', 'perplexity')}
            FROM latency GROUP BY label""", "latency"),
    "greedy_match": sql(
        f"SELECT pair_id, {r('precision', 'precision')}, {r('recall', 'recall')}, {r('f1', 'f1')} FROM greedy", extra=GREEDY),
    "greedy_match_means": sql(
        f"""SELECT {r('avg(precision)', 'bertscore_precision')}, {r('avg(recall)', 'bertscore_recall')},
                   {r('avg(f1)', 'bertscore_f1')} FROM greedy""", extra=GREEDY),

    "compare_models": sql(
        f"""SELECT metric, {r('b', 'base')}, {r('c', 'candidate')}, {r('c - b', 'delta')},
                   round(CASE WHEN b <> 0 THEN (c - b) / b * 100 ELSE 0 END, {DIGITS}) AS pct,
                   CASE WHEN c = b THEN 'same' WHEN (c > b) = (metric = 'bleu') THEN 'better' ELSE 'worse' END AS verdict
            FROM ({_delta_rows(['bleu', 'avg_pred_length', 'avg_latency_ms'], 'rec_base', 'rec_ft')})""",
        "pred_base", "pred_ft", extra=TWO_RECORDS.replace(f", {DIGITS}) AS bleu", ", 15) AS bleu")),
    "combine_records": sql(
        f"""SELECT 'base' AS base_label, (SELECT bleu FROM rec_base) AS base_bleu, 'tuned' AS finetuned_label,
                   {r('(SELECT avg_pred_length / greatest(avg_ref_length, 1) FROM rec_ft)', 'finetuned_length_ratio')}""",
        "pred_base", "pred_ft", extra=TWO_RECORDS),
    "metrics_extended": sql(
        f"""SELECT 'base' AS label, 'models/base' AS model_path, n_samples, {FULL},
                   (SELECT {r('exp(avg(latency_ms / 100))', 'p')} FROM latency) AS perplexity,
                   (SELECT {r('avg(precision)', 'p')} FROM greedy) AS bertscore_precision,
                   (SELECT {r('avg(recall)', 'p')} FROM greedy) AS bertscore_recall, (SELECT {r('avg(f1)', 'p')} FROM greedy) AS bertscore_f1
            FROM full_base""", "pred_base", "latency", extra=_record("pred_base", "base", None) + "," + GREEDY),
    "metrics_rounded": sql(
        """SELECT round(bleu, 4) AS bleu, round(avg_pred_length, 1) AS avg_pred_length, round(avg_ref_length, 1) AS avg_ref_length,
                  round(avg_pred_length / greatest(avg_ref_length, 1), 3) AS length_ratio, round(avg_latency_ms, 1) AS avg_latency_ms,
                  round(p95_latency_ms, 1) AS p95_latency_ms, 'base' AS label
           FROM rec_base""", "pred_base", "pred_ft", extra=TWO_RECORDS),
    "leaderboard": sql(
        "SELECT label, base_model, rank, first_module, " + ", ".join(f"round({c}, {DIGITS}) AS {c}" for c in (
            "perplexity", '"rougeL"', "bleu", "bertscore_f1", "avg_latency_ms", "avg_composite", "learning_rate")) + " FROM board",
        "runs", "latency", "judged", extra=BOARD),
    "leaderboard_by_metric": sql(
        f"""SELECT metric, {', '.join(f"round(max(value) FILTER (label = '{x}'), {DIGITS}) AS {x}" for x in ('click', 'error', 'purchase', 'signup', 'view'))}
            FROM ({' UNION ALL '.join(f"SELECT label, '{m}' AS metric, CAST({c} AS DOUBLE) AS value FROM board" for m, c in (
                ('perplexity', 'perplexity'), ('rougeL', '"rougeL"'), ('bleu', 'bleu'), ('bertscore_f1', 'bertscore_f1'), ('avg_latency_ms', 'avg_latency_ms'),
                ('avg_composite', 'avg_composite'), ('rank', 'rank'), ('learning_rate', 'learning_rate')))}) GROUP BY metric""",
        "runs", "latency", "judged", extra=BOARD),
    "compare_judge": sql(
        f"""SELECT label, metric, {r('b', 'base')}, {r('c', 'candidate')}, {r('c - b', 'delta')},
                   CASE WHEN c - b > 0 THEN 'better' ELSE 'worse' END AS verdict FROM ({' UNION ALL '.join(
                       f"SELECT label, '{m}' AS metric, coalesce((SELECT {m} FROM judged WHERE label = 'click'), 0) AS b, coalesce({m}, 0) AS c FROM judged WHERE label <> 'click'"
                       for m in fixed.JUDGE_METRICS)})""", "judged"),
    "example_sheet": sql(
        """SELECT b.instruction, b.prediction AS base_prediction, f.prediction AS ft_prediction, b.response, b.intent, b.category
           FROM s b JOIN pred_ft f ON f.example_id = b.example_id""", "pred_base", "pred_ft",
        extra=f"""s AS (SELECT * FROM pred_base QUALIFY row_number() OVER (
                 PARTITION BY intent ORDER BY {_key('example_id')}, example_id) <= 2)"""),

    "rating_prompt": sql(
        f"SELECT example_id, {_filled(fixed.RATING_PROMPT, instruction='instruction', response='prediction')} AS prompt FROM pred_base",
        "pred_base"),
    "preference_prompt": sql(
        f"""SELECT example_id, position, position % 2 = 1 AS swapped,
                   {_filled(fixed.PREFERENCE_PROMPT, instruction='instruction', response_a='a', response_b='b')} AS prompt
            FROM (SELECT p.example_id, p.instruction, p.position,
                         CASE WHEN p.position % 2 = 1 THEN f.prediction ELSE p.prediction END AS a,
                         CASE WHEN p.position % 2 = 1 THEN p.prediction ELSE f.prediction END AS b
                  FROM (SELECT *, row_number() OVER (ORDER BY example_id) - 1 AS position FROM pred_base) p
                  JOIN pred_ft f ON f.example_id = p.example_id)""", "pred_base", "pred_ft"),
    "parse_rating": sql("SELECT example_id, helpfulness, accuracy, professionalism, reasoning FROM rating", "rating"),
    "parse_preference": sql("SELECT example_id, winner, reasoning FROM rating", "rating"),
    "aggregate_scores": sql(
        "SELECT label, " + ", ".join(r(m, m) for m in fixed.JUDGE_METRICS[:3]) + f", {r('avg_composite', 'avg_composite')}, "
        "n_valid, n_failed FROM judged", "judged"),
    "win_rate": sql(
        f"""SELECT label, {r(RATES, 'win_rate_finetuned')}, {r(f'1 - {RATES}', 'win_rate_base')},
                   count(preference) AS n_preferences, count(*) FILTER (winner IS NULL) AS n_pref_failed
            FROM verdicts GROUP BY label""", "rating", extra=VERDICTS),
    "win_rate_strict": sql(
        f"""SELECT round({RATES} FILTER (winner IS NOT NULL), {DIGITS}) AS win_rate_finetuned,
                   round(1 - {RATES} FILTER (winner IS NOT NULL), {DIGITS}) AS win_rate_base,
                   count(winner) AS n_preferences, count(*) FILTER (winner IS NULL) AS n_pref_failed
            FROM verdicts""", "rating", extra=VERDICTS),
    "judge_details": sql(
        """SELECT example_id, position, intent, category,
                  CASE WHEN good THEN (k % 5 + 1)::DOUBLE END AS base_helpfulness,
                  CASE WHEN good THEN ((k + 1) % 5 + 1)::DOUBLE END AS base_accuracy,
                  CASE WHEN good THEN ((k + 2) % 5 + 1)::DOUBLE END AS base_professionalism,
                  CASE WHEN good THEN ((k + 1) % 5 + 1)::DOUBLE END AS ft_helpfulness,
                  CASE WHEN good THEN ((k + 2) % 5 + 1)::DOUBLE END AS ft_accuracy,
                  CASE WHEN good THEN ((k + 3) % 5 + 1)::DOUBLE END AS ft_professionalism,
                  winner, preference FROM preferred""", "preferred"),
    "judge_report": sql(
        f"""SELECT 'recorded' AS judge_model, count(*) AS n_samples,
                   round(avg((k % 5 + (k + 1) % 5 + (k + 2) % 5 + 3) / 3.0::DOUBLE) FILTER (good), {DIGITS}) AS base_composite,
                   round(avg(((k + 1) % 5 + (k + 2) % 5 + (k + 3) % 5 + 3) / 3.0::DOUBLE) FILTER (good), {DIGITS}) AS ft_composite,
                   round(avg((k + 1) % 5 + 1) FILTER (good), {DIGITS}) AS ft_helpfulness,
                   count(*) FILTER (NOT good) AS base_n_failed, {r(RATES, 'preference_win_rate_finetuned')},
                   {r(f'1 - {RATES}', 'preference_win_rate_base')}, count(*) FILTER (winner IS NULL) AS n_pref_failed
            FROM preferred""", "preferred"),
    "classify_errors": sql("SELECT example_id, kind, wait_seconds FROM errors", "errors"),
    "error_counts": sql(
        """SELECT kind, count(*) AS n_errors, count(wait_seconds) AS n_with_wait, sum(wait_seconds) AS total_wait_seconds
           FROM errors WHERE kind IS NOT NULL GROUP BY kind""", "errors"),

    "tool_calls": sql(
        """SELECT request_id, tool, CASE WHEN misnamed THEN 'order_number=' || whole_order_id ELSE concat_ws(',',
                    'amount=' || coalesce(CAST(amount AS VARCHAR), no_amount), 'customer_email=' || email, 'item_name=' || item_name, 'new_address=' || new_address,
                    'new_plan=' || new_plan, 'order_id=' || order_id, 'reason=' || reason, 'return_reason=' || return_reason) END AS args FROM asked
           UNION ALL SELECT request_id, NULL, NULL FROM agent_texts WHERE tool IS NULL""", "asked"),
    "tool_usage": sql("SELECT tool, count(*) AS n_calls FROM agent_texts WHERE tool IS NOT NULL GROUP BY tool", "agent_texts"),
    "tool_call_validity": sql(
        """SELECT request_id, tool, call_code AS code, CASE call_code WHEN 'unknown_tool' THEN 'Unknown tool: ' || tool
                  WHEN 'bad_arguments' THEN 'Tool call failed' END AS error FROM agent_texts WHERE tool IS NOT NULL""", "agent_texts"),
    "call_requests": sql(
        """SELECT request_id, tool AS action, order_id, email, new_plan, new_address, reason, item_name, return_reason, amount AS asked FROM asked""", "asked"),
    "call_outcomes": sql("SELECT request_id, tool, code, tool_result FROM told", "agent_texts", "with_order", "with_account", extra=TOLD),
    "invalid_tool_calls": sql(
        "SELECT request_id, tool, call_code AS code FROM agent_texts WHERE tool IS NOT NULL AND call_code <> 'ok'", "agent_texts"),

    "order_lookup": sql(
        f"""SELECT request_id, order_id, code, CASE code {ORDER_ERRORS} END AS error, status, order_date, estimated_delivery,
                   carrier, tracking_number, items, total, shipping_address,
                   CASE WHEN status = 'delivered' THEN delivered END AS delivered_date FROM d""", "with_order",
        extra="d AS (SELECT *, coalesce(bad_order, 'ok') AS code FROM with_order)"),
    "address_change": _ordered(
        ADDRESS_CODE, "order_id, new_address", f"WHEN 'already_shipped' THEN {_say('address_already_shipped', 'status')}",
        f"""CASE WHEN code = 'already_shipped' THEN carrier END AS carrier,
            CASE WHEN code = 'already_shipped' THEN tracking_number END AS tracking_number,
            {ok('shipping_address', 'old_address')}, {ok(_say('address_ok'), 'message')}"""),
    "cancel_order": _ordered(
        CANCEL_CODE, "order_id",
        f"""WHEN 'already_shipped' THEN {_say('cancel_already_shipped', 'status')}
            WHEN 'already_cancelled' THEN {_say('already_cancelled')}""",
        f"""{ok(STAMP, 'cancelled_at')}, {ok('total', 'refund_amount')}, {ok(_q(fixed.ORDER_REFUND_METHOD), 'refund_method')},
            {ok(_q(fixed.REFUND_ETA), 'refund_eta')}"""),
    "return_eligibility": _ordered(
        RETURN_CODE, "order_id",
        f"""WHEN 'not_delivered' THEN {_say('not_delivered', 'status')}
            WHEN 'window_expired' THEN {_say('window_expired', f'CAST({AGO} AS VARCHAR)')}""",
        f"""{ok(_q(fixed.RETURN_LABEL_URL) + ' || order_id', 'return_label_url')},
            {ok(_q(fixed.RETURN_INSTRUCTIONS), 'return_instructions')},
            {ok(_q(fixed.RETURN_REFUND_ETA), 'refund_eta')}, {ok(_q(fixed.RETURN_CARRIER), 'carrier')}"""),
    "account_lookup": sql(
        f"""SELECT request_id, email, code, CASE code {ACCOUNT_ERRORS} END AS error, account_status, subscription_plan,
                   member_since, total_orders, loyalty_points, payment_method, billing_cycle, next_billing_date FROM d""", "with_account",
        extra="d AS (SELECT *, coalesce(bad_account, 'ok') AS code FROM with_account)"),
    "account_unlock": _accounted(
        UNLOCK_CODE, "email", f"WHEN 'account_cancelled' THEN {_say('unlock_cancelled')}",
        f"""{ok(_say('unlock_ok'), 'message')}, {ok(_q(fixed.UNLOCK_ACTION), 'action_taken')}, {ok(STAMP, 'timestamp')}"""),
    "plan_change": _accounted(
        PLAN_CODE, "email, new_plan",
        f"""WHEN 'invalid_plan' THEN {_say('invalid_plan', 'new_plan')}
            WHEN 'account_blocked' THEN {_say('plan_blocked', 'account_status')}
            WHEN 'same_plan' THEN {_say('same_plan', 'new_plan')}
            WHEN 'unknown_stored_plan' THEN 'Unknown plan on the account: ' || subscription_plan""",
        f"""{ok('subscription_plan', 'old_plan')}, {ok(f"'$' || {OLD} || '/month'", 'old_price')},
            {ok(f"'$' || {NEW} || '/month'", 'new_price')},
            {ok(f"CASE WHEN {NEW} > {OLD} THEN 'immediately' ELSE 'next billing cycle' END", 'effective_date')},
            {ok(f"CASE WHEN {NEW} > {OLD} THEN '$' || ({NEW} - {OLD}) ELSE 'N/A' END", 'proration_credit')},
            {ok(f"CASE WHEN {NEW} > {OLD} THEN {_say('plan_upgraded', 'subscription_plan', 'new_plan')} ELSE {_say('plan_downgraded', 'subscription_plan', 'new_plan')} END", 'message')}"""),
    "cancel_subscription": _accounted(
        SUBSCRIPTION_CODE, "email", f"WHEN 'already_cancelled' THEN {_say('subscription_already_cancelled')}",
        f"""{ok("'1998-01-31'", 'cancellation_date')}, {ok("CAST(next_billing_date AS VARCHAR)", 'access_until')},
            {ok(_say('subscription_cancelled', 'CAST(next_billing_date AS VARCHAR)'), 'message')},
            {ok(_q(fixed.REACTIVATION_INFO), 'reactivation_info')}"""),
    "refund_routing": _accounted(
        REFUND_CODE, "email, order_id, amount",
        f"""WHEN 'refund_not_positive' THEN {_say('refund_not_positive')}
            WHEN 'escalated' THEN {_say('refund_escalated', MONEY)}""",
        f"""CASE WHEN code = 'escalated' THEN true END AS escalated,
            {ok(f"'REF-' || lpad(CAST({REFUND_NUMBER} AS VARCHAR), 6, '0')", 'refund_id')},
            {ok(f"'$' || {MONEY}", 'refund')}, {ok('payment_method', 'method')}, {ok(_q(fixed.REFUND_ETA), 'eta')},
            {ok(STAMP, 'timestamp')}, {ok(_say('refund_ok', MONEY, 'payment_method'), 'message')}"""),
    "adjudicate": sql(
        f"SELECT request_id, action, {SUCCESS} AS success, code, refund_amount FROM outcomes", "with_order", "with_account",
        extra=DECIDED),
    "adjudication_summary": sql(
        """SELECT action, code, count(*) AS n_requests, CAST(sum(refund_amount) AS DOUBLE) AS refund_amount
           FROM outcomes GROUP BY action, code""", "with_order", "with_account", extra=DECIDED),

    "with_predictions": sql("SELECT example_id, reverse(instruction) AS prediction, true AS timed FROM pairs", "pairs"),
    "with_replies": sql(
        """SELECT example_id, CASE WHEN length(instruction) % 5 <> 0 THEN (length(instruction) % 5 + 1)::DOUBLE END AS professionalism,
                  CASE WHEN length(instruction) % 5 = 0 THEN 'rate_limit' END AS kind,
                  CASE WHEN length(instruction) % 5 = 0 THEN 7.0::DOUBLE END AS wait_seconds FROM pairs""", "pairs"),
}

# Queries whose SQL is too slow for large tables (minutes at a thousand long texts); tests run it on small ones.
SMALL_ORACLES: dict[str, str] = {
    "metrics_documents": sql(
        f"SELECT category, 'half' AS label, 'models/half' AS model_path, n_samples, {FULL} FROM full_docs", "doc_predictions", extra=_record("doc_predictions", "docs", "category")),
}
