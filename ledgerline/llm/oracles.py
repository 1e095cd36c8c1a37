"""DuckDB SQL with the rows of those queries of this subpackage that SQL can express."""

from __future__ import annotations

_LOWER = "translate(text,'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz')"
_CONTROL = r"[<\[]\\*(\||s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)"
_REACH = "reach(a, b) AS (SELECT id, id FROM {nodes} UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a=r.b)"

_WORDS = r"list_transform(regexp_extract_all(text,'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: translate(t,'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'))"
_SPACE = "' '||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"


def _edit(state: str, cost: str, letter: str, line: str = "''") -> str:
    return f"{{'c':CAST({state}.c+{cost} AS BIGINT),'a':{state}.a||'{letter}','o':{state}.o||{line}}}"


def _read(state: str, terminal: str, role: str = "") -> str:
    """The ways to read a row as a terminal: as it is, or with the role given."""
    kept = _edit(state, "g.cut", "K", "chr(10)||g.role||':'||g.text")
    given = f",CASE WHEN g.f<2 THEN {_edit(state, '2+g.cut', 'R', f"chr(10)||'{role}:'||g.text")} END" if role else ""
    return f"CASE WHEN g.f<2 AND g.r='{terminal}' THEN {kept} END{given}"


def _insert(state: str, role: str) -> str:
    return _edit(state, "2", "I", f"chr(10)||'{role}:'")


# states of the roles: nothing yet, after the system's turn, a user's, an assistant's; nulls are no way
_REPAIR = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i,0,0,0,0,0,0,0,0], lambda c, x: CASE WHEN c%2=1 THEN xor(c//2,3988292384) ELSE c//2 END)) AS t),
k AS (
  SELECT conv_id, turn, coalesce(role,' ') AS role, coalesce(text,' ') AS text, xor(list_reduce(list_prepend(4294967295,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR),' ')||':'||coalesce(CAST(turn AS VARCHAR),' '),''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c//256,t[xor(c,b)%256+1])),4294967295)%20 AS k
  FROM conversations, crc
), d AS (
  SELECT conv_id, turn, CASE WHEN k=4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text,'[.!?]','','g') ELSE text END AS text,
    unnest(CASE WHEN k=3 THEN [1,2] ELSE [1] END) AS copy
  FROM k WHERE k<>0
), e AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, right(rtrim(text,{_SPACE}),1) AS last FROM d),
f AS (
  SELECT *, left(role,1) AS r, lag(left(role,1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN last='' THEN 2 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i)>1 THEN 3 WHEN last NOT IN ('.','!','?') THEN 1 ELSE 0 END AS f
  FROM e
), g AS (SELECT *, CAST(f=1 AS BIGINT) AS cut FROM f),
n AS (
  SELECT conv_id, coalesce(max(turn)-min(turn)+1-count(DISTINCT turn),0) AS gaps, count(*) FILTER (f=2) AS blank, count(*) FILTER (f=3) AS duplicate,
    count(*) FILTER (f=1) AS truncated, count(*) FILTER (before IS NOT NULL AND before||r NOT IN ('su','ua','au')) AS illegal, max(i) AS rows
  FROM g GROUP BY conv_id
), p AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c':CAST(0 AS BIGINT),'a':'','o':''}} AS s0, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)) AS s1,
    {{'c':CAST(2 AS BIGINT),'a':'I','o':chr(10)||'user:'}} AS s2, {{'c':CAST(4 AS BIGINT),'a':'II','o':chr(10)||'user:'||chr(10)||'assistant:'}} AS s3
  FROM n
  UNION ALL
  SELECT conv_id, i, s0, s1, s2, list_min([s3,{_insert("s2", "assistant")}]) FROM (
    SELECT conv_id, i, s0, s1, s3, list_min([s2,{_insert("s0", "user")},{_insert("s1", "user")},{_insert("s3", "user")}]) AS s2 FROM (
      SELECT p.conv_id, g.i, {_edit("s0", "3", "D")} AS s0, list_min([{_edit("s1", "3", "D")},{_read("s0", "s")}]) AS s1,
        list_min([{_edit("s2", "3", "D")},{_read("s0", "u", "user")},{_read("s1", "u", "user")},{_read("s3", "u", "user")}]) AS s2,
        list_min([{_edit("s3", "3", "D")},{_read("s2", "a", "assistant")}]) AS s3
      FROM p JOIN g ON p.conv_id IS NOT DISTINCT FROM g.conv_id AND g.i=p.i+1))
), b AS (SELECT n.*, list_min([s0,s3]) AS b FROM p JOIN n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i=n.rows)
SELECT c.conv_id, coalesce(gaps,0) AS gaps, coalesce(blank,0) AS blank, coalesce(duplicate,0) AS duplicate, coalesce(truncated,0) AS truncated,
  coalesce(illegal,0) AS illegal, coalesce(b.b.c,0) AS cost, coalesce(b.b.a,'') AS audit, sha256(coalesce(substr(b.b.o,2),'')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN b ON c.conv_id IS NOT DISTINCT FROM b.conv_id"""

ORACLES = {
    "op11_role_repair": _REPAIR,
    "op13_ranked_search": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS t FROM documents),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_WORDS}) AS t FROM benchmark) GROUP BY ALL),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t)>0),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
w AS (SELECT t, CAST(floor(1000*ln((CAST(2*n_docs AS DOUBLE)+2)/(2*df+1))) AS BIGINT) AS w FROM df, c),
s AS (
  SELECT item_id, doc_id, CAST(sum(times*w*((1000000000*tf)//(1000*tf+8*(100-75+(75*n*n_docs)//l)))) AS BIGINT) AS score
  FROM tf JOIN w USING (t) JOIN q USING (t), c GROUP BY ALL
), r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score>0)
SELECT * FROM r WHERE rank<=10""",
    "op3_chat_format": rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role,'') AS role, coalesce(text,'') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), c AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role||chr(10)||text||chr(10),'' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(CASE WHEN role='assistant' THEN text ELSE '' END,'' ORDER BY turn, role, text),'') AS loss,
    sum(23+length(role)+length(text)+len(regexp_extract_all(role,'{_CONTROL}'))+len(regexp_extract_all(text,'{_CONTROL}'))) AS formatted
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted AS BIGINT) AS formatted_chars FROM c""",
    "op4_ngram_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER},'[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w)>=5 THEN list_transform(range(1,len(w)-3), lambda i: array_to_string(w[i:i+4],' ')) WHEN len(w)>0 THEN [array_to_string(w,' ')] ELSE [] END) AS g FROM w
), n AS (SELECT doc_id AS id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g=y.g AND x.doc_id<y.doc_id GROUP BY 1,2),
links AS (SELECT a, b FROM pairs JOIN n p ON p.id=a JOIN n q ON q.id=b WHERE 100*k>=80*(p.n+q.n-k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
{_REACH.format(nodes="n")},
least AS (SELECT a AS id, min(b) AS c FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n,0) AS n_shingles, coalesce(l.c,d.doc_id) AS component_id FROM documents d LEFT JOIN n ON n.id=d.doc_id LEFT JOIN least l ON l.id=d.doc_id""",
    "op8_near_vectors": f"""
WITH RECURSIVE v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
links AS (SELECT p.id AS a, q.id AS b FROM v p JOIN v q ON p.id<q.id WHERE list_cosine_similarity(p.x,q.x)>=0.9),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
{_REACH.format(nodes="v")},
least AS (SELECT a AS id, min(b) AS c FROM reach GROUP BY 1),
deg AS (SELECT a AS id, count(*) AS k FROM both_ways GROUP BY 1)
SELECT v.id AS vec_id, coalesce(k,0) AS n_links, c AS component_id, v.id=c AS kept FROM v JOIN least USING (id) LEFT JOIN deg USING (id)""",
}
