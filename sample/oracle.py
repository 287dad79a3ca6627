"""The same queries as SQL over the Parquet files, to check the Spark results against."""

from __future__ import annotations

# Account tables derived from the sample data, each with the tables it reads.
_DERIVED: dict[str, tuple[tuple[str, ...], str]] = {
    "people": (
        (),
        """
        SELECT c_custkey AS k,
               CASE WHEN c_custkey % 11 = 0 THEN 'User' ELSE 'user' END || c_custkey AS nm,
               CASE WHEN c_custkey % 2 = 0 THEN 'user' || c_custkey
                    ELSE 'KEY' || (10000 + c_custkey) END AS ukey,
               c_mktsegment AS seg, n_nationkey AS nk, n_regionkey AS rk
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        """,
    ),
    "directory": (
        (),
        """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, r_name AS directory_name,
               r_regionkey <> 4 AS is_active, 4 - r_regionkey AS directory_position
        FROM region
        """,
    ),
    "placed": (
        ("people",),
        """
        SELECT *, CAST(1 AS BIGINT) AS d FROM people
        UNION ALL
        SELECT *, CAST(rk + 1 AS BIGINT) AS d FROM people WHERE k % 3 = 0 AND rk <> 0
        """,
    ),
    "account": (
        ("placed",),
        """
        SELECT k + 1000000 * d AS id, d AS directory_id, nm AS user_name,
               lower(nm) AS lower_user_name,
               CASE WHEN k % 17 <> 0 THEN nm || CASE WHEN nk % 5 = d % 5
                    THEN '@mycompany.example' ELSE '@customer.example' END END AS email_address,
               'Display ' || k AS display_name, 'ext-' || k AS external_id,
               CASE WHEN k % 23 <> 0 THEN k % 97 END AS credential,
               NOT ((k % 13 = 0 AND d = 1) OR (k % 15 = 0 AND d <> 1)) AS is_active,
               CASE WHEN k % 29 = 0 THEN NULL
                    WHEN k % 7 = 0 THEN TIMESTAMP '2001-06-15 00:00:00'
                    ELSE TIMESTAMP '1996-01-01 00:00:00' + to_days(CAST(k % 1000 AS INTEGER))
               END AS created_date
        FROM placed
        """,
    ),
    "grp": (
        (),
        """
        SELECT * FROM (VALUES (1, 'building-users'), (2, 'machinery-users'),
            (3, 'household-users'), (4, 'furniture-users'), (5, 'automobile-users'),
            (6, 'all-staff'), (900, 'never-deactivate')) AS g(id, group_name)
        """,
    ),
    "membership": (
        ("placed", "grp"),
        """
        SELECT k + 1000000 * d AS child_id, lower(nm) AS lower_child_name, d AS directory_id,
               grp.id AS parent_id, group_name AS lower_parent_name
        FROM (SELECT *, lower(seg) || '-users' AS held FROM placed
              UNION ALL SELECT *, 'all-staff' FROM placed WHERE k % 4 = 0
              UNION ALL SELECT *, 'never-deactivate' FROM placed WHERE k % 19 = 0)
        JOIN grp ON group_name = held
        """,
    ),
    "globalperm": (
        (),
        """
        SELECT * FROM (VALUES ('USE', 'building-users'), ('USE', 'machinery-users'),
            ('USE', 'household-users'), ('USE', 'all-staff'),
            ('ADMINISTER', 'machinery-users'), ('BULK_CHANGE', 'furniture-users'))
            AS p(permission, group_id)
        """,
    ),
    "license": (
        (),
        """
        SELECT * FROM (VALUES ('jira-software', 'building-users'),
            ('jira-software', 'machinery-users'), ('jira-software', 'all-staff'),
            ('jira-servicedesk', 'household-users')) AS r(license_role_name, group_id)
        """,
    ),
    "attrs": (
        ("placed",),
        """
        SELECT k + 1000000 * d AS user_id, d AS directory_id,
               CASE o_orderstatus
                   WHEN 'F' THEN CASE WHEN k % 5 <> 0 OR (k % 15 = 0 AND d <> 1)
                                      THEN 'login.lastLoginMillis'
                                      ELSE 'passwordLastChanged' END
                   WHEN 'P' THEN CASE WHEN k % 5 <> 1 THEN 'lastAuthenticated'
                                      ELSE 'passwordLastChanged' END
                   ELSE 'passwordLastChanged' END AS attribute_name,
               CASE WHEN o_orderstatus = 'P' THEN CAST(epoch_ms(o_orderdate) AS VARCHAR)
                    WHEN k % 15 = 0 AND d <> 1 THEN
                        CASE k % 60 WHEN 0 THEN 'unknown' WHEN 15 THEN ''
                                    WHEN 30 THEN '99999999999999999999'
                                    ELSE '9223372036854775807' END
                    WHEN k % 37 <> 0 THEN CAST(epoch_ms(o_orderdate) + 123 AS VARCHAR)
               END AS attribute_value
        FROM placed JOIN orders ON o_custkey = k
        """,
    ),
    "number": (
        ("attrs",),
        """
        SELECT user_id, directory_id, attribute_name,
               CASE WHEN TRY_CAST(attribute_value AS BIGINT)
                         BETWEEN -62135596800000 AND 253402300799999
                    THEN TRY_CAST(attribute_value AS BIGINT) END AS number,
               CASE WHEN number IS NULL THEN attribute_value END AS rest
        FROM attrs
        """,
    ),
    "changegroup": ((), "SELECT o_orderkey AS id, o_orderdate AS created FROM orders"),
    "changeitem": (
        ("people",),
        """
        SELECT l_orderkey AS groupid, ukey AS newvalue,
               CASE WHEN l_linenumber <> 1 OR l_orderkey % 4 <> 0 THEN 'comment'
                    WHEN l_returnflag = 'R' THEN 'assignee'
                    WHEN l_returnflag = 'A' THEN 'status'
                    ELSE 'priority' END AS field
        FROM (SELECT lineitem.*, l_partkey % customers AS owner
              FROM lineitem, (SELECT count(*) AS customers FROM customer))
        JOIN people ON k = owner
        """,
    ),
    "key_name": (("people",), "SELECT ukey AS user_key, lower(nm) AS lower_user_name FROM people"),
    "userassociation": (
        ("people",),
        """
        SELECT ukey AS source_name, ts AS created,
               CASE event_type WHEN 'view' THEN 'WatchIssue' ELSE 'VoteIssue' END
                   AS association_type
        FROM events JOIN people ON k = user_id
        """,
    ),
    "audit": (
        ("people",),
        """
        SELECT epoch_ms(o_orderdate) + o_orderkey % 1000 AS entity_timestamp,
               ukey AS primary_resource_id,
               CASE WHEN o_orderpriority <> '1-URGENT' THEN 'PROJECT'
                    WHEN o_orderkey % 3 = 0 THEN 'GROUP' ELSE 'USER' END
                   AS primary_resource_type,
               CASE WHEN o_orderkey % 2 = 0
                    THEN '[{"name":"Active","from":"Inactive","to":"Active"}]'
                    ELSE '[{"name":"Active","from":"Active","to":"Inactive"}]' END
                   AS change_values
        FROM orders JOIN people ON k = o_custkey
        """,
    ),
    "issue": (
        (),
        """
        SELECT CASE WHEN o_orderkey % 10 <> 0 THEN 'user' || o_custkey END AS assignee
        FROM orders
        """,
    ),
    "logininfo": (
        ("people",),
        """
        SELECT CASE WHEN o_orderstatus <> 'F' THEN 'gone-' ELSE '' END || ukey AS username,
               CASE WHEN k % 9 <> 0 THEN o_orderdate END AS successdate
        FROM people JOIN orders ON o_custkey = k
        """,
    ),
    "content": (
        ("people",),
        """
        SELECT CASE WHEN l_linestatus = 'O' AND k % 4 <> 0 THEN ukey END AS lastmodifier,
               l_shipdate AS lastmoddate
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN people ON k = o_custkey
        """,
    ),
    "spaceperm": (
        ("people",),
        """
        SELECT lower(seg) || '-users' AS permgroupname,
               CASE WHEN seg = 'FURNITURE' OR k % 5 <> 0 THEN k % 50 END AS spaceid
        FROM people
        UNION ALL
        SELECT 'all-staff', CASE WHEN k % 20 <> 0 THEN k % 50 END FROM people WHERE k % 4 = 0
        """,
    ),
    # Operators that other queries build on.
    "access_members": (
        ("membership", "globalperm"),
        """
        SELECT DISTINCT lower_child_name AS lower_user_name, directory_id
        FROM membership
        WHERE lower_parent_name IN
            (SELECT group_id FROM globalperm WHERE permission IN ('USE', 'ADMINISTER'))
        """,
    ),
    "open_account": (
        ("account", "directory"),
        """
        SELECT account.*, directory_position
        FROM account JOIN directory ON directory.id = account.directory_id
        WHERE directory.is_active
        """,
    ),
    "canonical": (
        ("open_account", "access_members"),
        """
        SELECT * FROM open_account
        WHERE is_active
          AND (lower_user_name, directory_id) IN
              (SELECT (lower_user_name, directory_id) FROM access_members)
        QUALIFY row_number() OVER (
            PARTITION BY user_name ORDER BY directory_position, directory_id, id) = 1
        """,
    ),
    "resolved": (
        ("open_account",),
        """
        SELECT * FROM open_account
        QUALIFY row_number() OVER (
            PARTITION BY lower_user_name ORDER BY directory_position, directory_id, id) = 1
        """,
    ),
    "exempt": (
        ("account", "membership", "grp"),
        """
        SELECT user_name FROM account, membership, grp
        WHERE account.id = child_id AND grp.id = parent_id AND group_name = 'never-deactivate'
        """,
    ),
    "activity": (
        ("number",),
        """
        SELECT user_id, directory_id,
               max(make_timestamp(number * 1000))
                   FILTER (attribute_name = 'login.lastLoginMillis') AS lastlogin,
               max(make_timestamp(number * 1000))
                   FILTER (attribute_name = 'lastAuthenticated') AS lastauth
        FROM number GROUP BY ALL
        """,
    ),
    "assignment": (
        ("changegroup", "changeitem"),
        """
        SELECT newvalue AS user_name, max(created) AS lastassign
        FROM changeitem, changegroup
        WHERE groupid = changegroup.id AND changeitem.field = 'assignee' GROUP BY ALL
        """,
    ),
    "watch": (
        ("userassociation", "key_name", "account"),
        """
        SELECT account.user_name, max(userassociation.created) AS lastwatch
        FROM account, key_name, userassociation
        WHERE account.lower_user_name = key_name.lower_user_name
          AND key_name.user_key = source_name AND association_type = 'WatchIssue'
        GROUP BY ALL
        """,
    ),
    "reactivation": (
        ("audit", "key_name"),
        """
        SELECT lower_user_name AS user_name,
               max(CAST(make_timestamp((entity_timestamp // 1000) * 1000000) AS DATE))
                   AS lastreactivate
        FROM audit, key_name
        WHERE user_key = primary_resource_id AND primary_resource_type = 'USER'
          AND ends_with(change_values, '"from":"Inactive","to":"Active"}]')
        GROUP BY ALL
        """,
    ),
    "assigned": (
        ("issue",),
        """
        SELECT assignee AS user_name, count(*) AS assigneecount
        FROM issue WHERE assignee IS NOT NULL GROUP BY ALL
        """,
    ),
    "judged": (
        ("canonical", "activity", "assignment", "watch", "reactivation", "assigned", "exempt"),
        """
        SELECT c.user_name, c.directory_id, email_address,
               strftime(created_date, '%Y-%m-%d') AS created,
               strftime(lastlogin, '%Y-%m-%d') AS lastlogin,
               strftime(lastauth, '%Y-%m-%d') AS lastauth,
               strftime(lastassign, '%Y-%m-%d') AS lastassign,
               strftime(lastwatch, '%Y-%m-%d') AS lastwatch,
               strftime(lastreactivate, '%Y-%m-%d') AS lastreactivate,
               ifnull(assigneecount, 0) AS assigneecount,
               greatest(created_date, lastlogin, lastauth, lastassign,
                        CAST(lastreactivate AS TIMESTAMP)) AS last_active
        FROM canonical c
        LEFT JOIN activity a ON a.user_id = c.id AND a.directory_id = c.directory_id
        LEFT JOIN assignment s ON s.user_name = c.user_name
        LEFT JOIN reactivation r ON r.user_name = c.user_name
        LEFT JOIN watch w ON w.user_name = c.user_name
        LEFT JOIN assigned n ON n.user_name = c.user_name
        WHERE created_date IS NOT NULL AND c.user_name NOT IN (SELECT user_name FROM exempt)
        """,
    ),
    "dormant": (
        ("judged",),
        """
        SELECT * EXCLUDE (last_active) FROM judged
        WHERE last_active < TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 3 MONTH
        """,
    ),
    "dormant_before": (
        ("judged",),
        """
        SELECT * EXCLUDE (last_active) FROM judged
        WHERE last_active < TIMESTAMP '2001-05-31 06:00:00' - INTERVAL 3 MONTH
        """,
    ),
    # The days on which the cut gets past the last activity; the first of them is that of the expiry.
    "past": (
        ("judged",),
        """
        SELECT user_name, last_active, day
        FROM (SELECT user_name, last_active, CAST(unnest(generate_series(
                         date_trunc('day', last_active), last_active + INTERVAL 5 MONTH, INTERVAL 1 DAY)) AS TIMESTAMP) AS day
              FROM judged)
        WHERE day + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND - INTERVAL 3 MONTH > last_active
        """,
    ),
    "external": (
        ("dormant",),
        """
        SELECT * EXCLUDE (directory_id, assigneecount) FROM dormant
        WHERE directory_id = 1 AND NOT ends_with(email_address, '@mycompany.example')
        """,
    ),
    "by_login": (
        ("account", "resolved", "number"),
        """
        SELECT a.user_name, a.created_date,
               ifnull(CAST(v.number AS VARCHAR), v.rest) AS last_login_millis,
               CASE WHEN v.number IS NULL THEN a.created_date ELSE epoch_ms(v.number) END
                   AS last_used,
               CASE WHEN v.number IS NULL THEN 'never_logged_in' ELSE 'login' END AS reason
        FROM account a
        JOIN resolved r ON r.lower_user_name = a.lower_user_name
        LEFT JOIN (SELECT user_id, directory_id, max(number) AS number, max(rest) AS rest
                   FROM number WHERE attribute_name = 'login.lastLoginMillis' GROUP BY ALL) v
             ON v.user_id = r.id AND v.directory_id = r.directory_id
        WHERE a.is_active AND a.directory_id = 1
          AND (v.number IS NOT NULL OR ifnull(v.rest, '') = '')
          AND last_used + INTERVAL 1 YEAR < TIMESTAMP '2001-08-02 00:00:00'
        """,
    ),
    "plan": (
        ("external", "resolved"),
        """
        SELECT x.user_name, r.id AS account_id, r.directory_id,
               CASE WHEN r.id IS NULL THEN 'not_found'
                    WHEN NOT r.is_active THEN 'already_inactive'
                    WHEN r.directory_id <> 1 THEN 'validation_failed'
                    ELSE 'deactivated' END AS status,
               CASE status
                   WHEN 'deactivated' THEN 'Deactivated ' || x.user_name
                       || ': email_address=' || ifnull(x.email_address, 'null')
                       || ', created=' || ifnull(x.created, 'null')
                       || ', lastlogin=' || ifnull(x.lastlogin, 'null')
                       || ', lastauth=' || ifnull(x.lastauth, 'null')
                       || ', lastassign=' || ifnull(x.lastassign, 'null')
                       || ', lastwatch=' || ifnull(x.lastwatch, 'null')
                       || ', lastreactivate=' || ifnull(x.lastreactivate, 'null')
                   ELSE 'Failed to deactivate ' || x.user_name || ': ' || CASE status
                       WHEN 'not_found' THEN 'Not found'
                       WHEN 'already_inactive' THEN 'Already inactive'
                       ELSE 'directory is read-only' END
               END AS detail
        FROM external x LEFT JOIN resolved r ON r.lower_user_name = lower(x.user_name)
        """,
    ),
    "login_plan": (
        ("by_login", "resolved"),
        """
        SELECT x.user_name, r.id AS account_id, r.directory_id,
               CASE WHEN r.id IS NULL THEN 'not_found'
                    WHEN NOT r.is_active THEN 'already_inactive'
                    WHEN r.directory_id <> 1 THEN 'validation_failed'
                    ELSE 'deactivated' END AS status,
               CASE status
                   WHEN 'deactivated' THEN 'Deactivated ' || x.user_name
                       || ': created_date=' || ifnull(CAST(x.created_date AS VARCHAR), 'null')
                       || ', last_login_millis=' || ifnull(x.last_login_millis, 'null')
                       || ', last_used=' || CAST(x.last_used AS VARCHAR)
                       || ', reason=' || x.reason
                   ELSE 'Failed to deactivate ' || x.user_name || ': ' || CASE status
                       WHEN 'not_found' THEN 'Not found'
                       WHEN 'already_inactive' THEN 'Already inactive'
                       ELSE 'directory is read-only' END
               END AS detail
        FROM by_login x LEFT JOIN resolved r ON r.lower_user_name = lower(x.user_name)
        """,
    ),
    "global_groups": (
        ("spaceperm",),
        "SELECT permgroupname FROM spaceperm WHERE spaceid IS NULL GROUP BY permgroupname",
    ),
    "wiki_user": (
        ("account", "directory"),
        """
        SELECT account.*, directory_name
        FROM account JOIN directory ON directory.id = directory_id WHERE account.is_active
        """,
    ),
    "edits": (
        ("content", "key_name", "wiki_user"),
        """
        SELECT wiki_user.user_name, max(lastmoddate) AS lastpagemoddate
        FROM wiki_user, key_name, content
        WHERE wiki_user.lower_user_name = key_name.lower_user_name
          AND key_name.user_key = lastmodifier
        GROUP BY ALL
        """,
    ),
    "wiki_quiet": (
        ("wiki_user", "logininfo", "key_name", "membership", "grp", "global_groups", "edits",
         "exempt"),
        """
        SELECT u.user_name, u.email_address, u.directory_name, u.created_date,
               l.successdate, e.lastpagemoddate
        FROM wiki_user u
        JOIN key_name m ON m.lower_user_name = u.lower_user_name
        JOIN logininfo l ON l.username = m.user_key
        LEFT JOIN edits e ON e.user_name = u.user_name
        WHERE u.created_date < TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 6 MONTH
          AND ifnull(l.successdate < TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 6 MONTH, true)
          AND u.id IN (SELECT child_id FROM membership JOIN grp ON grp.id = parent_id
                       WHERE lower(group_name) IN (SELECT permgroupname FROM global_groups))
          AND u.user_name NOT IN (SELECT user_name FROM exempt)
        """,
    ),
}

_AS_TEXT = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}"

_WIKI_ROWS = """
    SELECT DISTINCT '[~' || user_name || ']' AS mention, email_address, directory_name,
           strftime(created_date, '%Y-%m-%d') AS user_created,
           strftime(successdate, '%Y-%m-%d') AS lastlogin,
           strftime(lastpagemoddate, '%Y-%m-%d') AS lastpagemoddate
    FROM wiki_quiet
    WHERE {quiet}
"""

_SUMMARY = """
    SELECT status, count(*) AS users,
           CASE WHEN status = 'deactivated'
                THEN count(*) || ' inactive users automatically deactivated.' END AS message
    FROM {plan} GROUP BY status
"""


def _sql(needs: tuple[str, ...], body: str) -> str:
    """The query with the derived tables it needs, in the order of their definition."""
    wanted: set[str] = set()
    pending = list(needs)
    while pending:
        name = pending.pop()
        if name not in wanted:
            wanted.add(name)
            pending.extend(_DERIVED[name][0])
    tables = ",\n".join(
        f"{name} AS ({sql})" for name, (_, sql) in _DERIVED.items() if name in wanted
    )
    return f"WITH {tables}\n{body}"


def _texts(*columns: str) -> str:
    return ", ".join(_AS_TEXT.format(column) for column in columns)


ORACLE_SQL: dict[str, str] = {
    "dormant_accounts": _sql(("dormant",), "SELECT * FROM dormant"),
    "dormant_external": _sql(("external",), "SELECT * FROM external"),
    "licensed_accounts": _sql(
        ("open_account", "membership", "license"),
        f"""
        SELECT user_name, email_address, display_name, {_texts("created_date")}
        FROM (SELECT user_name, email_address, display_name, max(created_date) AS created_date
              FROM open_account
              WHERE is_active AND lower_user_name IN (
                  SELECT lower_child_name FROM membership WHERE lower_parent_name IN (
                      SELECT group_id FROM license WHERE license_role_name = 'jira-software'))
              GROUP BY ALL)
        """,
    ),
    "dormant_by_login_rule": _sql(
        ("by_login",),
        f"""
        SELECT user_name, last_login_millis, reason, {_texts("created_date", "last_used")}
        FROM by_login
        """,
    ),
    "deactivation_plan": _sql(("plan",), "SELECT * FROM plan"),
    "deactivation_summary": _sql(("plan",), _SUMMARY.format(plan="plan")),
    "accounts_after": _sql(
        ("plan", "account"),
        f"""
        SELECT id, directory_id, user_name, lower_user_name, email_address, display_name,
               external_id, credential,
               CAST(is_active AND id NOT IN
                   (SELECT account_id FROM plan WHERE status = 'deactivated') AS INTEGER) AS active,
               {_texts("created_date")}
        FROM account
        """,
    ),
    "login_rule_plan": _sql(("login_plan",), "SELECT * FROM login_plan"),
    "login_rule_summary": _sql(("login_plan",), _SUMMARY.format(plan="login_plan")),
    "canonical_account": _sql(
        ("canonical",),
        f"SELECT user_name, directory_id, id, email_address, {_texts('created_date')} FROM canonical",
    ),
    "access_members": _sql(("access_members",), "SELECT * FROM access_members"),
    "exempt_accounts": _sql(("exempt",), "SELECT * FROM exempt"),
    "not_exempt": _sql(
        ("canonical", "exempt"),
        """
        SELECT user_name, directory_id, id FROM canonical
        WHERE user_name NOT IN (SELECT user_name FROM exempt)
        """,
    ),
    "active_account_count": _sql(
        ("account",), "SELECT count(*) AS active_accounts FROM account WHERE is_active"
    ),
    "account_activity": _sql(
        ("account", "activity"),
        f"""
        SELECT id, account.directory_id, user_name, {_texts("lastlogin", "lastauth")}
        FROM account LEFT JOIN activity
          ON user_id = id AND activity.directory_id = account.directory_id
        WHERE is_active
        """,
    ),
    "last_assignment": _sql(
        ("assignment",), f"SELECT user_name, {_texts('lastassign')} FROM assignment"
    ),
    "last_watch": _sql(("watch",), f"SELECT user_name, {_texts('lastwatch')} FROM watch"),
    "last_reactivation": _sql(
        ("reactivation",),
        "SELECT user_name, strftime(lastreactivate, '%Y-%m-%d') AS lastreactivate FROM reactivation",
    ),
    "assignee_count": _sql(("assigned",), "SELECT * FROM assigned"),
    "account_expiry": _sql(
        ("past",),
        f"""
        SELECT user_name, {_texts("last_active", "expires_at")},
               strftime(expires_at, '%Y-%m-%d') AS expires_on
        FROM (SELECT user_name, last_active,
                     CASE WHEN min(day) - INTERVAL 3 MONTH > last_active THEN min(day)
                          ELSE min(day) + (last_active - date_trunc('day', last_active)) + INTERVAL 1 MICROSECOND
                     END AS expires_at
              FROM past GROUP BY user_name, last_active)
        """,
    ),
    "newly_dormant": _sql(
        ("dormant", "dormant_before"), "SELECT * FROM dormant EXCEPT SELECT * FROM dormant_before"
    ),
    "activity_from_state": _sql(
        ("assignment", "reactivation", "watch", "issue"),
        f"""
        SELECT user_name, {_texts("lastassign", "lastwatch")},
               strftime(lastreactivate, '%Y-%m-%d') AS lastreactivate, assigneecount
        FROM (SELECT user_name, max(lastassign) AS lastassign, max(lastreactivate) AS lastreactivate,
                     max(lastwatch) AS lastwatch, CAST(sum(n) AS BIGINT) AS assigneecount
              FROM (SELECT user_name, lastassign, NULL AS lastreactivate, NULL AS lastwatch, NULL AS n
                    FROM assignment
                    UNION ALL SELECT user_name, NULL, lastreactivate, NULL, NULL FROM reactivation
                    UNION ALL SELECT user_name, NULL, NULL, lastwatch, NULL FROM watch
                    UNION ALL SELECT assignee, NULL, NULL, NULL, 1 FROM issue)
              GROUP BY user_name)
        """,
    ),
    "rejected_logins": _sql(
        ("attrs",),
        """
        SELECT *, CASE WHEN trim(attribute_value) = '' THEN 'empty'
                       WHEN TRY_CAST(attribute_value AS DOUBLE) IS NULL THEN 'not_a_number'
                       ELSE 'out_of_range' END AS reason
        FROM attrs
        WHERE attribute_name IN ('login.lastLoginMillis', 'lastAuthenticated') AND attribute_value IS NOT NULL
          AND ifnull(TRY_CAST(attribute_value AS DOUBLE) NOT BETWEEN -62135596800000 AND 253402300799999, true)
        """,
    ),
    "wiki_dormant": _sql(
        ("wiki_quiet",),
        _WIKI_ROWS.format(
            quiet="""successdate IS NULL
               OR lastpagemoddate < TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 6 MONTH"""
        ),
    ),
    "wiki_dormant_strict": _sql(
        ("wiki_quiet",),
        _WIKI_ROWS.format(
            quiet="""lastpagemoddate IS NULL
               OR lastpagemoddate < TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 6 MONTH"""
        ),
    ),
    "wiki_global_groups": _sql(("global_groups",), "SELECT * FROM global_groups"),
    "wiki_last_edit": _sql(
        ("edits",), f"SELECT user_name, {_texts('lastpagemoddate')} FROM edits"
    ),
}
