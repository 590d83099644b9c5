"""DuckDB SQL for every query with a SQL equivalent (the correctness oracle).

Written independently of the Spark plans, as plain SQL over the driver's
tables: the fixture views are CTEs; only the course's tables (tasks, kinds) and
the default address are shared with the Spark side, because they are inputs.
Character lists and patterns are written anew here.
"""

from __future__ import annotations

from gatehouse.plans.fixtures import DEFAULT_BASE_URL, DEFAULT_SETTINGS, EXCEPTIONS, KINDS, TASKS


def _q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _list(xs: list[str] | None) -> str:
    return "NULL::VARCHAR[]" if xs is None else "[" + ", ".join(_q(x) for x in xs) + "]"


# Fixed values, as code points: what Python's str.isspace accepts below U+3100.
SPACES = " || ".join(f"chr({c})" for c in (
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200,
    8201, 8202, 8232, 8233, 8239, 8287, 12288))

# The accepted address in RE2 terms: scheme, empty user info, a bracketed or
# plain host, port (group 1), path, and at most an empty query and fragment.
ADDRESS = r"\A(?i:http|https)://(?::?@)?(?:\[[0-9a-fA-F:.]+\]|[^\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}/?#@:\[\]]+)(?::([0-9]*))?(?:/[^?#]*)?\??#?\z"


def strip_sql(x: str) -> str:
    return f"trim({x}, {SPACES})"


def base_sql(x: str) -> str:
    return f"rtrim({strip_sql(x)}, '/')"


def valid_sql(b: str) -> str:
    port = f"ltrim(regexp_extract({b}, {_q(ADDRESS)}, 1), '0')"
    return (f"coalesce(regexp_matches({b}, {_q(ADDRESS)}) and "
            f"({port} = '' or (length({port}) <= 5 and try_cast({port} as integer) <= 65535)), false)")


def blank_sql(x: str) -> str:
    return f"({strip_sql(x)} = '')"


TASK_CASE = f"case sub_id % {len(TASKS)} " + " ".join(
    f"when {slot} then {_q(tid)}" for slot, tid, *_ in TASKS) + " end"

VIEWS = {
    "endpoints_v": r"""
select page_id as req_id, case page_id % 16
  when 0 then chr(9) || ' ' || url || chr(10)
  when 1 then url || '///'
  when 2 then replace(url, '://', '://u:p@')
  when 3 then replace(url, 'http', 'ftp')
  when 4 then 'http://h' || cast(page_id as varchar) || '.example:65536'
  when 5 then 'HTTPS://h' || cast(page_id as varchar) || '.example:8080/base/'
  when 6 then 'http://@h' || cast(page_id as varchar)
  when 7 then ''
  when 8 then 'http://h' || cast(page_id as varchar) || '?'
  when 9 then 'http://[::1]:' || cast(page_id as varchar)
  when 10 then chr(160) || 'http://h_' || cast(page_id as varchar)
  when 11 then 'http://h' || cast(page_id as varchar) || chr(10) || '/'
  when 12 then 'http://h' || cast(page_id as varchar) || chr(13) || '/'
  when 13 then 'http://h' || cast(page_id as varchar) || chr(8232) || '/'
  when 14 then 'http://h' || cast(page_id as varchar) || ':80' || chr(10) || '/'
  else url end as raw_url
from pages""",
    "tasks_v": "select * from (values " + ", ".join(
        f"({slot}::BIGINT, {_q(tid)}, {_q(ep)}::VARCHAR, {_list(exp)}, {str(bundle).lower()})"
        for slot, tid, ep, exp, bundle in TASKS) + ") t(slot, task_id, endpoint, expected, bundle)",
    "kinds_v": "select * from (values " + ", ".join(
        f"({_q(n)}, {_q(k)})" for n, k in KINDS) + ") t(name, kind)",
    "exceptions_v": "select * from (values " + ", ".join(
        f"({_q(t)}, {_q(n)}, {_q(k)})" for t, n, k in EXCEPTIONS) + ") t(task_id, name, kind)",
    "submissions_v": f"""
select conv_id as sub_id,
  case when conv_id % 13 = 0 then ' ' || chr(9) else 'u' || cast(conv_id as varchar) end as student_id,
  {TASK_CASE.replace('sub_id', 'conv_id')} as task_id,
  turn as pos,
  role || '_' || cast(turn as varchar) || '.py' as name,
  case (conv_id * 3 + turn) % 29
    when 0 then '' when 1 then ' ' || chr(9) || chr(10)
    when 2 then text || ' TODO'
    when 3 then 'raise NotImplementedError ' || text
    when 4 then text || chr(13) || chr(10) || 'x'
    else text end as content
from conversations""",
    "explicit_v": """
select conv_id as sub_id, turn as pos,
  case when conv_id % 3 = 0 and turn < conv_id % 4
       then 'in/' || conv_id || '/' || role || '_' || turn || '.py' end as path
from conversations""",
    "stored_v": f"""
select path, case when readable then content end as content, content as bytes, readable from (
  select 'in/' || s.sub_id || '/' || c.role || '_' || s.pos || '.py' as path, s.content,
    (s.sub_id * 7 + s.pos) % 31 <> 5 as readable
  from submissions_v s join conversations c on c.conv_id = s.sub_id and c.turn = s.pos
  where (s.sub_id * 7 + s.pos) % 31 <> 7
  union all
  select 'work/' || s.sub_id || '/' || s.task_id || '/' || t.expected[s.pos + 1],
    case when {blank_sql('s.content')} then s.content else '# start' || chr(10) || s.content end,
    (s.sub_id * 7 + s.pos) % 31 <> 6
  from submissions_v s join tasks_v t on t.task_id = s.task_id
  where t.expected[s.pos + 1] is not null and (s.sub_id * 7 + s.pos) % 31 <> 8)""",
    "settings_v": """
select req_id as key, case when req_id % 7 <> 3 then raw_url end as base_url,
  case req_id % 5 when 0 then null when 1 then '' else 'k' || req_id end as student_key
from endpoints_v""",
    "responses_v": """
select event_id as sub_id, ts,
  case event_id % 20 when 0 then 500 when 1 then null else 200 end as http_status,
  case event_id % 20 when 1 then 'timeout' else null end as transport_error,
  case event_id % 20
    when 0 then 'oops' when 1 then null when 2 then 'not json' when 3 then '[1]'
    when 4 then '{"status":"success","message":1}'
    when 5 then '{"status":"ok","message":"m"}'
    when 6 then '{"status":"error","message":""}'
    when 7 then '{"status":"success"}' when 8 then ''
    when 9 then '{"status":["success"],"message":"m"}'
    when 10 then '{"status":"success","message":null}' when 11 then 'null'
    when 12 then 'null x' when 13 then '"a" b'
    when 14 then chr(65279) || '{"status":"success","message":"bom"}'
    when 15 then '-1.5e3' when 16 then '1 2'
    when 17 then '{"message":"first ' || repeat('ab\\n', 500) || '","status":"error","more":{"message":"' || repeat('inner ', 300)
         || '"},"message":"' || event_type || repeat(' \\"q\\" xyz', 300) || '","status":"'
         || case when event_type = 'error' then 'error' else 'success' end || '"}'
    when 18 then '{"status":"success","message":"' || repeat('long ', 300) || '","message":2}'
    else '{"status":"' || case when event_type = 'error' then 'error' else 'success' end
         || '","message":"' || event_type || '"}' end as body
from events""",
}


def with_views(names: list[str], body: str, extra: list[tuple[str, str]] = ()) -> str:
    ctes = [f"{n} as ({VIEWS[n]}\n)" for n in names] + [f"{n} as ({q}\n)" for n, q in extra]
    return "with " + ",\n".join(ctes) + "\n" + body


# ---- screen building blocks (shared CTEs) ----------------------------------------

ARITY_CTES = [
    ("headers", "select sub_id, max(student_id) as student_id, max(task_id) as task_id "
                "from submissions_v group by sub_id"),
    ("counts", "select sub_id, count(path) as n from explicit_v group by sub_id"),
    ("arity", """
select h.sub_id, h.task_id, h.student_id, t.endpoint, t.expected, coalesce(t.bundle, false) as bundle,
  cast(coalesce(c.n, 0) as bigint) as n_explicit,
  case when coalesce(t.bundle, false)
       then coalesce(c.n, 0) = 0 or coalesce(c.n, 0) = len(t.expected)
       else coalesce(c.n, 0) <= 1 end as arity_ok,
  coalesce(c.n, 0) > 0 or t.expected is not null as has_files
from headers h left join tasks_v t on h.task_id = t.task_id
left join counts c on c.sub_id = h.sub_id"""),
]


def manifest_cte(src: str) -> tuple[str, str]:
    return ("manifest", f"""
select e.sub_id, a.task_id, e.pos, a.expected[e.pos + 1] as name, e.path, 'explicit' as source
from explicit_v e join {src} a on a.sub_id = e.sub_id
where e.path is not null
union all
select sub_id, task_id, pos, expected[pos + 1] as name,
  'work/' || sub_id || '/' || task_id || '/' || expected[pos + 1] as path, 'default' as source
from (select sub_id, task_id, expected, unnest(range(len(expected))) as pos
      from {src} where n_explicit = 0 and expected is not null)""")


RECONCILE_CTES = [
    ("reconciled", """
select m.sub_id, m.task_id, m.pos, m.name, m.path,
  case when s.path is null then 'missing' when not s.readable then 'unreadable' when strlen(s.content) = 0 then 'empty'
       when """ + blank_sql("s.content") + """ then 'blank' else 'ok' end as state
from manifest m left join stored_v s on s.path = m.path"""),
    ("failures", """
select sub_id, min(pos) filter (where state <> 'ok') as fail_pos,
  arg_min(name, pos) filter (where state <> 'ok') as fail_name,
  arg_min(state, pos) filter (where state <> 'ok') as fail_state
from reconciled group by sub_id"""),
]

CHECKED_CTE = ("checked", f"""
select a.*, coalesce(o.raw_url, {_q(DEFAULT_BASE_URL)}) as base_url,
  case when a.endpoint is null then 'no_endpoint'
       when not a.arity_ok then 'bad_arity'
       when not a.has_files then 'no_default_file'
       when not {valid_sql(base_sql("coalesce(o.raw_url, " + _q(DEFAULT_BASE_URL) + ")"))} then 'bad_address'
       when a.student_id is null or {blank_sql("a.student_id")} then 'blank_student'
  end as header_reason
from arity a left join endpoints_v o on o.req_id = a.sub_id""")

SCREEN_CTES = ARITY_CTES + [CHECKED_CTE, ("passing", "select * from checked where header_reason is null"),
                            manifest_cte("passing")] + RECONCILE_CTES + [("screened", """
select c.sub_id, c.task_id, c.base_url, coalesce(c.header_reason, f.fail_state) as reason,
  case when c.header_reason is null then f.fail_pos end as fail_pos,
  c.student_id, c.expected, c.endpoint, c.bundle
from checked c left join failures f on f.sub_id = c.sub_id""")]

SUB_VIEWS = ["endpoints_v", "tasks_v", "submissions_v", "explicit_v", "stored_v"]

BUNDLE_SQL = ("bundles", """
select sub_id, cast(sum(strlen(c)) as bigint) as bundle_bytes,
  case when bool_and(c is not null) and bool_and(name is not null) then
    '{' || string_agg(cast(to_json(name) as varchar) || ': ' || cast(to_json(c) as varchar), ', '
                      order by pos) || '}' end as solution
from (select m.sub_id, m.pos, m.name, regexp_replace(s.content, '\\r\\n?', chr(10), 'g') as c
      from manifest m left join stored_v s on s.path = m.path) group by sub_id""")

# one verdict per response
VERDICT_CTES = [("bodies", """
select *, case when json_valid(ltrim(body, chr(65279))) then ltrim(body, chr(65279)) end as j from responses_v"""),
# of repeated keys the last counts
("members", """
select b.sub_id, arg_max(m.type, m.id) filter (where m.key = 'status') as st_type, arg_max(m.value, m.id) filter (where m.key = 'status') as st_json,
  arg_max(m.type, m.id) filter (where m.key = 'message') as msg_type, arg_max(m.value, m.id) filter (where m.key = 'message') as msg_json
from (select sub_id, j from bodies where json_type(j) = 'OBJECT') b, json_each(b.j) m
where m.key in ('status', 'message') group by b.sub_id"""),
("parsed", """
select b.sub_id, http_status, transport_error, j, m.st_json ->> '$' as st, m.msg_json ->> '$' as msg,
  case when j is null then 'malformed'
       when json_type(j) = 'OBJECT' and m.st_type = 'VARCHAR' and m.st_json ->> '$' in ('success', 'error')
        and m.msg_type = 'VARCHAR' then 'ok'
       else 'unexpected' end as shape
from bodies b left join members m on m.sub_id = b.sub_id"""), ("verdicts", """
select sub_id, shape,
  case when shape = 'ok' then st end as status,
  case when shape = 'ok' then msg end as message,
  case when http_status is not null and not (http_status between 200 and 299) then 'http_error'
       when transport_error is not null or http_status is null then 'unreachable'
       when shape = 'malformed' then 'malformed'
       when shape = 'unexpected' then 'unexpected'
       else st end as outcome
from parsed""")]


def match_sql(seconds: int) -> str:
    return f"""
with q as (select event_id, user_id, ts from events where event_type = 'click'),
r as (select event_id, user_id, ts from events where event_type = 'view'),
m as (
  select q.event_id as req_id, q.user_id, r.event_id as resp_id,
    epoch_us(r.ts) - epoch_us(q.ts) as delay_us,
    row_number() over (partition by q.event_id
                       order by epoch_us(r.ts) - epoch_us(q.ts), r.event_id) as rn
  from q left join r on r.user_id = q.user_id and r.ts >= q.ts
    and r.ts < q.ts + to_microseconds({seconds * 1_000_000}))
select req_id, user_id, resp_id, cast(delay_us as bigint) as delay_us from m where rn = 1"""


REQUEST_CTES = SCREEN_CTES + [("sent_files", """
select m.sub_id, m.pos, m.name, regexp_replace(s.content, '\\r\\n?', chr(10), 'g') as c
from manifest m join stored_v s on s.path = m.path"""), ("sendable", """
select sc.sub_id, sc.task_id, sc.student_id, sc.base_url, sc.endpoint,
  case when sc.bundle
       then '{' || string_agg(cast(to_json(f.name) as varchar) || ': ' || cast(to_json(f.c) as varchar), ', '
                              order by f.pos) || '}'
       else max(f.c) end as solution
from screened sc join sent_files f on f.sub_id = sc.sub_id
where sc.reason is null
group by sc.sub_id, sc.task_id, sc.student_id, sc.bundle, sc.base_url, sc.endpoint"""), ("requests", """
select p.sub_id, p.task_id, """ + base_sql("p.base_url") + """ || p.endpoint as target_url,
  cast(json_object('student_id', """ + strip_sql("p.student_id") + """,
                   'student_solution', p.solution) as varchar) as request
from sendable p""")]


def stream_match_sql(seconds: int, delay_seconds: int) -> str:
    """J3 minus the requests still waiting in state when the input ends.

    A request is emitted once its deadline (ts + limit) is before the final
    watermark: the latest click/view time, in ms, minus the delay.
    """
    w_us = seconds * 1_000_000
    return f"""
with j3 as ({match_sql(seconds)}),
wm as (select ((epoch_us(max(ts)) // 1000) - {delay_seconds * 1000}) * 1000 as wm_us
       from events where event_type in ('click', 'view')),
q as (select event_id, epoch_us(ts) as us from events where event_type = 'click')
select j3.req_id, j3.user_id, j3.resp_id, j3.delay_us
from j3 join q on q.event_id = j3.req_id cross join wm
where q.us + {w_us} < wm.wm_us"""


def oracle_sql() -> dict[str, str]:
    s = {}
    s["p1_strip"] = with_views(["endpoints_v"], f"select req_id, {strip_sql('raw_url')} as url_stripped from endpoints_v")
    s["p2_rstrip_slash"] = with_views(["endpoints_v"], f"select req_id, {base_sql('raw_url')} as base_url from endpoints_v")
    s["f1_valid_base_url"] = with_views(
        ["endpoints_v"], f"select req_id, base_url, {valid_sql('base_url')} as valid "
                         f"from (select req_id, {base_sql('raw_url')} as base_url from endpoints_v)")
    s["p3_target_url"] = with_views(
        ["endpoints_v", "tasks_v"],
        f"select e.req_id, t.task_id, {base_sql('e.raw_url')} || t.endpoint as target_url "
        f"from endpoints_v e left join tasks_v t on t.slot = e.req_id % {len(TASKS)}")
    s["p4_overlay"] = with_views(
        ["endpoints_v", "settings_v"],
        f"select e.event_id as sub_id, coalesce(o.base_url, {_q(DEFAULT_BASE_URL)}) as base_url, "
        f"case when o.base_url is null then 'default' else 'override' end as base_url_source, "
        f"coalesce(o.student_key, {_q(DEFAULT_SETTINGS['student_key'])}) as student_key, "
        f"case when o.student_key is null then 'default' else 'override' end as student_key_source "
        f"from events e left join settings_v o on o.key = e.event_id")
    s["p5_normalise_newlines"] = with_views(
        ["submissions_v"],
        "select sub_id, pos, regexp_replace(content, '\\r\\n?', chr(10), 'g') as content, "
        "regexp_replace(content, '\\r\\n?', chr(10), 'g') <> content as changed from submissions_v")
    s["f2_blank_student"] = with_views(
        ["submissions_v"], f"select distinct sub_id, {blank_sql('student_id')} as student_blank from submissions_v")
    s["f3_blank_file"] = with_views(["submissions_v"], f"select sub_id, pos, {blank_sql('content')} as blank from submissions_v")
    s["f4_endpoint_available"] = with_views(
        ["submissions_v", "tasks_v"],
        "select h.sub_id, h.task_id, t.endpoint is not null as available from "
        "(select distinct sub_id, task_id from submissions_v) h left join tasks_v t on t.task_id = h.task_id")
    s["f5_placeholder_flags"] = with_views(
        ["submissions_v"],
        r"select sub_id, pos, regexp_matches(content, '(^|[^0-9A-Za-z_])TODO($|[^0-9A-Za-z_])') as has_todo, "
        r"regexp_matches(content, '(^|[^0-9A-Za-z_])NotImplementedError($|[^0-9A-Za-z_])') as has_not_implemented "
        "from submissions_v")
    s["a1_check_arity"] = with_views(
        SUB_VIEWS, "select sub_id, task_id, n_explicit, arity_ok, has_files from arity", ARITY_CTES)
    s["j2_resolve_paths"] = with_views(
        SUB_VIEWS, "select sub_id, task_id, pos, name, path, source from manifest",
        ARITY_CTES + [manifest_cte("arity")])
    s["j1_artifact_kind"] = with_views(
        SUB_VIEWS + ["kinds_v", "exceptions_v"],
        "select m.sub_id, m.pos, m.name, coalesce(x.kind, k.kind) as kind from manifest m "
        "left join exceptions_v x on x.task_id = m.task_id and x.name = m.name "
        "left join kinds_v k on k.name = m.name",
        ARITY_CTES + [manifest_cte("arity")])
    s["s2_reconcile"] = with_views(
        SUB_VIEWS, "select sub_id, pos, name, path, state from reconciled",
        ARITY_CTES + [manifest_cte("arity")] + RECONCILE_CTES[:1])
    s["a3_first_failure"] = with_views(
        SUB_VIEWS, "select sub_id, fail_pos, fail_name, fail_state from failures",
        ARITY_CTES + [manifest_cte("arity")] + RECONCILE_CTES)
    s["a2_assemble_bundle"] = with_views(
        SUB_VIEWS, "select sub_id, bundle_bytes, solution from bundles",
        ARITY_CTES + [("countable", "select * from arity where arity_ok"), manifest_cte("countable"), BUNDLE_SQL])
    s["x4_screen_files"] = with_views(
        SUB_VIEWS, "select sub_id, task_id, base_url, reason, fail_pos from screened", SCREEN_CTES)
    s["x4_screen_colocated"] = s["x4_screen_files"]
    s["x4_screen"] = with_views(
        SUB_VIEWS, "select sub_id, task_id, base_url, reason, fail_pos from screened", SCREEN_CTES)
    s["p6_request_json"] = with_views(SUB_VIEWS, "select sub_id, task_id, target_url, request from requests",
                                      REQUEST_CTES)
    s["s3_write_requests"] = with_views(SUB_VIEWS, "select request from requests", REQUEST_CTES)
    s["x1_parse_verdict"] = with_views(["responses_v"], "select sub_id, shape, status, message from verdicts", VERDICT_CTES)
    s["x2_classify"] = with_views(["responses_v"], "select sub_id, outcome from verdicts", VERDICT_CTES)
    s["x3_exit_code"] = with_views(
        ["responses_v"],
        "select sub_id, outcome, cast(case when outcome = 'success' then 0 else 1 end as bigint) as exit_code "
        "from verdicts", VERDICT_CTES)
    s["s1_read_artifacts"] = with_views(
        ["tasks_v", "submissions_v", "stored_v"],
        "select path as file, cast(strlen(bytes) + case when readable then 0 else 1 end as bigint) as n_bytes, "
        f"readable, {blank_sql('content')} as blank from stored_v")
    s["s4_write_verdicts"] = with_views(
        ["responses_v"],
        "select sub_id, outcome, message, cast(case when outcome = 'success' then 0 else 1 end as bigint) "
        "as exit_code from verdicts", VERDICT_CTES)
    s["t1_match_within_stream"] = stream_match_sql(300, 600)
    s["judge_stream"] = with_views(
        ["responses_v"],
        "select m.req_id, m.user_id, m.resp_id, v.shape, v.status, v.message, coalesce(v.outcome, 'unreachable') as outcome, "
        "cast(case when v.outcome = 'success' then 0 else 1 end as bigint) as exit_code "
        "from answered m left join verdicts v on v.sub_id = m.resp_id",
        VERDICT_CTES + [("answered", stream_match_sql(4 * 3600, 600))])
    s["j3_match_within_300s"] = match_sql(300)
    s["j3_match_within_4h"] = match_sql(4 * 3600)
    s["j3_match_within_300s_balanced"] = match_sql(300)
    return s
