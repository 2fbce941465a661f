"""DuckDB twins of the named queries (the correctness oracle).

Tables are the driver's pre-registered views.  Shared CTEs below restate
the derivation rules of ``sources.driver_tables`` in SQL.
"""

from __future__ import annotations

# u in [0,1) from md5(key): first 8 hex digits / 2^32
def _u(key_sql: str) -> str:
    return f"(('0x' || substr(md5({key_sql}), 1, 8))::BIGINT / 4294967296.0)"


def _split(id_sql: str) -> str:
    u = _u(f"'split|' || CAST({id_sql} AS VARCHAR)")
    return f"(CASE WHEN {u} < 0.85 THEN 'train' WHEN {u} < 0.90 THEN 'dev' ELSE 'test' END)"


TOKENS_SQL = r"list_filter(regexp_split_to_array(lower({t}), '[^\p{{L}}]+'), lambda x: x <> '')"


def tokens_of(text_sql: str) -> str:
    return TOKENS_SQL.format(t=text_sql)


MANIFEST_CTE = f"""
m AS (
  SELECT d.doc_id AS id,
         'img/' || printf('%05d', d.doc_id) || '.png' AS img,
         CAST(l.toxic AS INTEGER) AS label,
         d.text AS text,
         {_split('d.doc_id')} AS split
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

LAYOUT_CTE = """
lay AS (
  SELECT id, split,
         CASE WHEN label = 1 THEN 'hateful' WHEN label = 0 THEN 'non_hateful' ELSE 'unlabelled' END AS class,
         regexp_extract(img, '[^/]*$', 0) AS filename
  FROM m
),
layp AS (
  SELECT id, split, class, 'image_' || split || '/' || class || '/' || filename AS path FROM lay
)"""

IMAGE_CTE = f"""
imgf AS (
  SELECT printf('%05d', vec_id) || '.png' AS filename,
         CAST(label < 3 AS INTEGER) AS label,
         embedding AS resnet_features,
         {_split('vec_id')} AS split
  FROM embeddings
)"""

TEXT_DIM = 32

TEXT_EMB_CTE = f"""
tok AS (
  SELECT id, img, label, split, {tokens_of('text')} AS tokens FROM m
),
tb AS (
  SELECT img, ('0x' || substr(md5(t), 1, 8))::BIGINT % {TEXT_DIM} AS b, count(*) AS c
  FROM (SELECT img, unnest(tokens) AS t FROM tok) GROUP BY ALL
),
tn AS (SELECT img, len(tokens) AS n FROM tok),
temb AS (
  SELECT tn.img,
         list(CAST(CASE WHEN tn.n = 0 THEN 0.0 ELSE coalesce(tb.c, 0) / tn.n END AS FLOAT) ORDER BY r.b)
           AS text_embedding
  FROM tn CROSS JOIN (SELECT range AS b FROM range({TEXT_DIM})) r
  LEFT JOIN tb ON tb.img = tn.img AND tb.b = r.b
  GROUP BY tn.img
)"""

FUSED_CTE = """
fz AS (
  SELECT i.filename, i.split, i.label,
         list_concat(i.resnet_features, t.text_embedding) AS mm
  FROM imgf i JOIN temb t ON i.filename = regexp_extract(t.img, '[^/]*$', 0)
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


ORACLE: dict[str, str] = {}

ORACLE["ingest_manifest"] = with_ctes(MANIFEST_CTE, body="SELECT id, img, label, text, split FROM m")

ORACLE["split_counts"] = with_ctes(MANIFEST_CTE, body="SELECT split, count(*)::BIGINT AS n FROM m GROUP BY split")

ORACLE["basename_key"] = with_ctes(
    MANIFEST_CTE, body="SELECT id, regexp_extract(img, '[^/]*$', 0) AS filename FROM m")

ORACLE["image_layout"] = with_ctes(MANIFEST_CTE, LAYOUT_CTE, body="SELECT id, split, class, path FROM layp")

ORACLE["folder_label"] = with_ctes(MANIFEST_CTE, LAYOUT_CTE, body="""
SELECT id, class AS folder,
       CAST(CASE WHEN contains(lower(string_split(path, '/')[-2]), 'hateful')
                  AND NOT contains(lower(string_split(path, '/')[-2]), 'non_hateful')
                 THEN 1 ELSE 0 END AS INTEGER) AS label
FROM layp""")

ORACLE["fuse_concat"] = with_ctes(MANIFEST_CTE, IMAGE_CTE, TEXT_EMB_CTE, FUSED_CTE, body="""
SELECT filename, split, label, len(mm)::BIGINT AS width,
       round(list_sum(list_transform(range(len(mm)), lambda i: CAST(mm[i + 1] AS DOUBLE) * (i + 1))), 6) AS feat_sum
FROM fz""")

WV_DIM = 300
MAX_TOKENS = 80

WORDVEC_CTE = f"""
alltok AS (SELECT DISTINCT unnest({tokens_of('text')}) AS token FROM documents),
wv AS (
  SELECT token,
         list_transform(range({WV_DIM}),
           lambda i: CAST(((a * (i + 1) + b * i * i) % 4294967296) / 4294967296.0 - 0.5 AS FLOAT)) AS vector
  FROM (SELECT token, ('0x' || substr(md5(token), 1, 8))::BIGINT AS a, ('0x' || substr(md5(token), 9, 8))::BIGINT AS b
        FROM alltok WHERE substr(md5(token), 1, 1) <> '0')
),
vocab AS (SELECT DISTINCT unnest(tokens) AS token FROM tok WHERE split = 'train'),
pv AS (SELECT token, vector FROM wv WHERE token IN (SELECT token FROM vocab))"""

LOOKUP_CTE = f"""
ex AS (
  SELECT id, split, unnest(k) AS token, generate_subscripts(k, 1) - 1 AS pos
  FROM (SELECT id, split, tokens[1:{MAX_TOKENS}] AS k FROM tok)
),
lk AS (
  SELECT ex.id, ex.split, ex.pos, ex.token,
         CASE WHEN pv.token IS NULL THEN 0 ELSE 1 END AS hit,
         coalesce(list_sum(CAST(pv.vector AS DOUBLE[])), 0.0) AS vs,
         pv.vector AS vector
  FROM ex LEFT JOIN pv ON ex.token = pv.token
)"""

ORACLE["processed_text"] = with_ctes(MANIFEST_CTE, body=r"""
SELECT id, img, trim(regexp_replace(text, '[ \t\n\r\f\x0B]+', ' ', 'g')) AS text, label, split FROM m""")

ORACLE["text_tokens"] = with_ctes(MANIFEST_CTE, TEXT_EMB_CTE, body="""
SELECT id, split, len(tokens)::BIGINT AS n_tokens, md5(array_to_string(tokens, ' ')) AS tokens_md5 FROM tok""")

ORACLE["tokens_truncated"] = with_ctes(MANIFEST_CTE, TEXT_EMB_CTE, body=f"""
SELECT id, len(tokens[1:{MAX_TOKENS}])::BIGINT AS n_kept,
       md5(array_to_string(tokens[1:{MAX_TOKENS}], ' ')) AS kept_md5 FROM tok""")

ORACLE["vocabulary"] = with_ctes(MANIFEST_CTE, TEXT_EMB_CTE, WORDVEC_CTE, body="SELECT token FROM vocab")

ORACLE["wordvec_pruned"] = with_ctes(MANIFEST_CTE, TEXT_EMB_CTE, WORDVEC_CTE, body="""
SELECT token, len(vector)::BIGINT AS dim, round(list_sum(CAST(vector AS DOUBLE[])), 6) AS vsum FROM pv""")

ORACLE["token_lookup"] = with_ctes(MANIFEST_CTE, TEXT_EMB_CTE, WORDVEC_CTE, LOOKUP_CTE, body="""
SELECT id, pos::BIGINT AS pos, token, CAST(hit AS INTEGER) AS hit, round(vs, 6) AS vsum FROM lk""")

ORACLE["oov_rate"] = with_ctes(MANIFEST_CTE, TEXT_EMB_CTE, WORDVEC_CTE, LOOKUP_CTE, body="""
SELECT split, count(*)::BIGINT AS n_tokens, sum(1 - hit)::BIGINT AS n_oov,
       round(avg(CAST(1 - hit AS DOUBLE)), 6) AS oov_rate
FROM lk GROUP BY split""")

ORACLE["sequence_shape"] = with_ctes(MANIFEST_CTE, TEXT_EMB_CTE, WORDVEC_CTE, LOOKUP_CTE, body=f"""
SELECT t.id, {MAX_TOKENS}::BIGINT AS n_rows, {WV_DIM}::BIGINT AS min_cols, {WV_DIM}::BIGINT AS max_cols,
       coalesce(h.n, 0)::BIGINT AS n_nonzero_rows
FROM tok t LEFT JOIN (SELECT id, sum(hit) AS n FROM lk GROUP BY id) h ON t.id = h.id""")

ORACLE["sequence_checksum"] = with_ctes(MANIFEST_CTE, TEXT_EMB_CTE, WORDVEC_CTE, LOOKUP_CTE, body="""
SELECT t.id, t.split, round(coalesce(c.s, 0.0), 6) AS checksum
FROM tok t LEFT JOIN (SELECT id, sum((pos + 1) * vs) AS s FROM lk GROUP BY id) c ON t.id = c.id""")

ORACLE["fuse_concat_seq"] = with_ctes(MANIFEST_CTE, TEXT_EMB_CTE, WORDVEC_CTE, LOOKUP_CTE, IMAGE_CTE, body=f"""
, pool0 AS (
  SELECT l.id, r.j, sum(CAST(l.vector[r.j + 1] AS DOUBLE)) AS s
  FROM lk l CROSS JOIN (SELECT range AS j FROM range({WV_DIM})) r
  WHERE l.hit = 1 GROUP BY l.id, r.j
),
pool AS (
  SELECT regexp_extract(t.img, '[^/]*$', 0) AS filename,
         list(CAST(coalesce(p.s, 0.0) / {MAX_TOKENS} AS FLOAT) ORDER BY r.j) AS seqf
  FROM tok t CROSS JOIN (SELECT range AS j FROM range({WV_DIM})) r
  LEFT JOIN pool0 p ON p.id = t.id AND p.j = r.j
  GROUP BY t.id, t.img
)
SELECT filename, split, label, len(mm)::BIGINT AS width,
       round(list_sum(list_transform(range(len(mm)), lambda i: CAST(mm[i + 1] AS DOUBLE) * (i + 1))), 6) AS feat_sum
FROM (SELECT i.filename, i.split, i.label, list_concat(i.resnet_features, p.seqf) AS mm
      FROM imgf i JOIN pool p ON i.filename = p.filename)""")

ORACLE["label_validation"] = with_ctes(MANIFEST_CTE, body="""
SELECT split,
       count(*) FILTER (WHERE label < 0 OR label > 1)::BIGINT AS n_invalid,
       count(*) FILTER (WHERE label IS NULL)::BIGINT AS n_null,
       count(*)::BIGINT AS n_rows
FROM m GROUP BY split""")

ORACLE["class_counts"] = with_ctes(MANIFEST_CTE, body="SELECT split, label, count(*)::BIGINT AS n FROM m GROUP BY split, label")

ORACLE["class_weights"] = with_ctes(MANIFEST_CTE, body="""
, c AS (SELECT label, count(*) AS n FROM m WHERE split = 'train' AND label IN (0, 1) GROUP BY label),
k AS (SELECT * FROM (VALUES (0), (1)) v(label)),
p AS (SELECT k.label::INTEGER AS label, coalesce(c.n, 0)::BIGINT AS n FROM k LEFT JOIN c ON k.label = c.label),
t AS (SELECT sum(n) AS total, sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) AS present FROM p)
SELECT label, n, round(CASE WHEN present < 2 THEN 1.0 ELSE total / (present * n) END, 6) AS weight
FROM p, t""")

SCALED_CTE = """
lf AS (
  SELECT filename, split, label, unnest(range(len(mm))) AS i, unnest(mm) AS x FROM fz
),
st AS (
  SELECT i, avg(CAST(x AS DOUBLE)) AS mu, stddev_samp(CAST(x AS DOUBLE)) AS sd
  FROM lf WHERE split = 'train' GROUP BY i
),
z AS (
  SELECT lf.filename, lf.split, lf.label, lf.i,
         CASE WHEN st.sd = 0 THEN 0.0 ELSE (CAST(lf.x AS DOUBLE) - st.mu) * (1.0 / st.sd) END AS z
  FROM lf JOIN st ON lf.i = st.i
)"""

_FZ = (MANIFEST_CTE, IMAGE_CTE, TEXT_EMB_CTE, FUSED_CTE)

ORACLE["scaler_stats"] = with_ctes(*_FZ, SCALED_CTE, body="""
SELECT i::BIGINT AS dim, round(mu, 6) AS mean, round(sd, 6) AS std FROM st""")

ORACLE["scaled_features"] = with_ctes(*_FZ, SCALED_CTE, body="""
SELECT filename, split, i::BIGINT AS dim, round(z, 6) AS value FROM z""")

ORACLE["fixed_width"] = with_ctes(IMAGE_CTE, body="""
SELECT filename, len(resnet_features[1:48])::BIGINT AS w_cut,
       round(list_sum(CAST(resnet_features[1:48] AS DOUBLE[])), 6) AS sum_cut,
       80::BIGINT AS w_pad, round(list_sum(CAST(resnet_features AS DOUBLE[])), 6) AS sum_pad
FROM imgf""")

ORACLE["covariance"] = with_ctes(*_FZ, SCALED_CTE, body="""
, zt AS (SELECT filename, i, z FROM z WHERE split = 'train')
SELECT a.i::BIGINT AS i, b.i::BIGINT AS j, round(covar_samp(a.z, b.z), 6) AS cov
FROM zt a JOIN zt b ON a.filename = b.filename AND a.i <= b.i
GROUP BY a.i, b.i""")

BALANCE_CTE = """
bi AS (SELECT filename, label, CAST(mm AS DOUBLE[]) AS x FROM fz WHERE split = 'train'),
cs AS (SELECT label, count(*) AS n FROM bi GROUP BY label),
mi AS (SELECT label AS minor FROM cs ORDER BY n, label DESC LIMIT 1),
mx AS (SELECT max(n) AS nmax, min(n) AS nmin FROM cs),
mino AS (SELECT filename, x FROM bi WHERE label = (SELECT minor FROM mi)),
pr AS (
  SELECT a.filename AS f, b.filename AS g, list_distance(a.x, b.x) AS d
  FROM mino a JOIN mino b ON a.filename <> b.filename
),
knn AS (
  SELECT f, g, d, row_number() OVER (PARTITION BY f ORDER BY d, g) AS rank
  FROM pr QUALIFY rank <= 3
)"""


def _su(tag: str) -> str:
    return _u(f"'smote|42|' || CAST(s AS VARCHAR) || '|{tag}'")


SMOTE_CTE = f"""
num AS (SELECT filename, row_number() OVER (ORDER BY filename) - 1 AS idx FROM mino),
dr AS (
  SELECT s,
         ('0x' || substr(md5('smote|42|' || CAST(s AS VARCHAR) || '|base'), 1, 15))::BIGINT % (SELECT count(*) FROM mino) AS idx,
         CAST(floor({_su('nbr')} * 3) + 1 AS INTEGER) AS rank,
         {_su('step')} AS step
  FROM (SELECT unnest(range((SELECT nmax - nmin FROM mx))) AS s)
),
syn AS (
  SELECT dr.s, num.filename AS base_filename, knn.g AS nbr_filename, dr.rank, dr.step,
         list_transform(range(len(xb.x)), lambda i: xb.x[i + 1] + dr.step * (xn.x[i + 1] - xb.x[i + 1])) AS xnew
  FROM dr JOIN num ON dr.idx = num.idx
  JOIN knn ON knn.f = num.filename AND knn.rank = dr.rank
  JOIN mino xb ON xb.filename = num.filename
  JOIN mino xn ON xn.filename = knn.g
)"""

_BI = _FZ + (BALANCE_CTE,)

ORACLE["minority_knn"] = with_ctes(*_BI, body="""
SELECT f AS filename, CAST(rank AS INTEGER) AS rank, g AS nbr_filename, round(d, 6) AS dist FROM knn""")

ORACLE["smote_synthetic"] = with_ctes(*_BI, SMOTE_CTE, body="""
SELECT s::BIGINT AS s, base_filename, nbr_filename, rank, round(step, 6) AS step,
       round(list_sum(list_transform(range(len(xnew)), lambda i: xnew[i + 1] * (i + 1))), 6) AS feat_sum
FROM syn""")

ORACLE["smote_balanced"] = with_ctes(*_BI, SMOTE_CTE, body="""
, al AS (SELECT label, 0 AS is_syn, x FROM bi
         UNION ALL SELECT (SELECT minor FROM mi), 1, xnew FROM syn)
SELECT CAST(label AS INTEGER) AS label, count(*)::BIGINT AS n, sum(is_syn)::BIGINT AS n_synthetic,
       round(sum(list_sum(list_transform(range(len(x)), lambda i: x[i + 1] * (i + 1)))), 3) AS feat_sum
FROM al GROUP BY label""")


def _w(seed_sql: str) -> str:
    return _u(f"'w|' || CAST({seed_sql} AS VARCHAR) || '|' || CAST(i AS VARCHAR)") + " - 0.5"


SCORED_CTE = f"""
sx AS (SELECT filename, split, label, CAST(mm AS DOUBLE[]) AS x FROM fz),
sc AS (
  SELECT filename, split, label,
         list_sum(list_transform(range(len(x)), lambda i: x[i + 1] * ({_w('1')}))) AS margin
  FROM sx
),
sl AS (
  SELECT *, CASE WHEN margin > 0 THEN 1 ELSE 0 END AS pred,
         ln(1 + exp(-abs(margin))) + greatest(margin, 0.0) - label * margin AS loss
  FROM sc
)"""

ROUNDS_CTE = f"""
rx AS (
  SELECT r.round, sx.label,
         list_sum(list_transform(range(len(sx.x)), lambda i: sx.x[i + 1] * ({_w('r.round')}))) AS margin
  FROM sx CROSS JOIN (SELECT unnest(range(1, 9)) AS round) r
  WHERE sx.split = 'dev'
),
rm AS (
  SELECT round,
         avg(CASE WHEN (CASE WHEN margin > 0 THEN 1 ELSE 0 END) = label THEN 1.0 ELSE 0.0 END) * 100.0 AS dev_accuracy,
         avg(ln(1 + exp(-abs(margin))) + greatest(margin, 0.0) - label * margin) AS dev_log_loss
  FROM rx GROUP BY round
)"""

ORACLE["argmax_predictions"] = with_ctes(*_FZ, SCORED_CTE, body="""
SELECT filename, CAST(pred AS INTEGER) AS predicted_label FROM sl WHERE split = 'test'""")

ORACLE["dev_accuracy"] = with_ctes(*_FZ, SCORED_CTE, body="""
SELECT count(*)::BIGINT AS n, sum(CASE WHEN pred = label THEN 1 ELSE 0 END)::BIGINT AS n_correct,
       round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END) * 100.0, 6) AS accuracy
FROM sl WHERE split = 'dev' AND label IS NOT NULL""")

ORACLE["dev_log_loss"] = with_ctes(*_FZ, SCORED_CTE, body="""
SELECT count(*)::BIGINT AS n, round(avg(loss), 6) AS log_loss
FROM sl WHERE split = 'dev' AND label IS NOT NULL""")

ORACLE["best_round"] = with_ctes(*_FZ, SCORED_CTE, ROUNDS_CTE, body="""
SELECT CAST(round AS INTEGER) AS round, round(dev_accuracy, 6) AS dev_accuracy,
       round(dev_log_loss, 6) AS dev_log_loss,
       CAST(row_number() OVER (ORDER BY dev_accuracy DESC, round ASC) = 1 AS INTEGER) AS is_best
FROM rm""")

ORACLE["early_stop"] = with_ctes(*_FZ, SCORED_CTE, ROUNDS_CTE, body="""
, a AS (
  SELECT round, dev_log_loss,
         min(dev_log_loss) OVER (ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_best
  FROM rm
),
b AS (
  SELECT *, max(CASE WHEN prev_best IS NULL OR dev_log_loss < prev_best THEN round END)
              OVER (ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_improved
  FROM a
),
s AS (SELECT coalesce(min(CASE WHEN round - last_improved >= 3 THEN round END), max(round)) AS stopped FROM b),
c AS (
  SELECT b.round, b.dev_log_loss, s.stopped,
         row_number() OVER (ORDER BY b.dev_log_loss, b.round) AS rk
  FROM b, s WHERE b.round <= s.stopped
)
SELECT CAST(stopped AS INTEGER) AS stopped_round, CAST(round AS INTEGER) AS restored_round,
       round(dev_log_loss, 6) AS best_loss
FROM c WHERE rk = 1""")

def _feistel(x: str) -> str:
    """Two-half network of six steps over (h, keys) of the row, as nested SQL."""
    pair = f"{{'l': {x} >> h, 'r': {x} & (1::BIGINT << h) - 1}}"
    fold = f"""list_reduce(list_prepend({pair}, list_transform(keys, lambda k: {{'l': k.a, 'r': k.b}})), lambda s, k:
      {{'l': s.r, 'r': xor(s.l, (((s.r * k.l + k.r) % 2147483647) * ((s.r * k.l + k.r) % 2147483647)) % 2147483647 & (1::BIGINT << h) - 1)}})"""
    return f"({fold}.l << h | {fold}.r)"


def _step_key(tag: str) -> str:
    return f"('0x' || substr(md5('feistel|42|' || epoch || '|' || s || '|{tag}'), 1, 8))::BIGINT % 2147483646 + 1"


ORACLE["epoch_shuffle"] = "WITH RECURSIVE " + with_ctes(*_FZ, body=f"""
, t AS (SELECT filename, (row_number() OVER (ORDER BY filename) - 1)::BIGINT AS x, (count(*) OVER ())::BIGINT AS n FROM fz WHERE split = 'train'),
e AS (SELECT epoch, list({{'a': {_step_key('a')}, 'b': {_step_key('b')}}} ORDER BY s) AS keys
      FROM range(1, 4) ep(epoch), range(6) st(s) GROUP BY epoch),
b AS (SELECT *, greatest(1, (length(bin(n - 1)) + 1) // 2)::BIGINT AS h FROM t, e),
walk(epoch, filename, n, h, keys, v) AS (
  SELECT epoch, filename, n, h, keys, {_feistel('x')} FROM b
  UNION ALL
  SELECT epoch, filename, n, h, keys, {_feistel('v')} FROM walk WHERE v >= n)
SELECT CAST(epoch AS INTEGER) AS epoch, filename, v::BIGINT AS position FROM walk WHERE v < n""").removeprefix("WITH ")

ORACLE["text_embedding"] = with_ctes(MANIFEST_CTE, TEXT_EMB_CTE, body="""
SELECT img, len(text_embedding)::BIGINT AS width,
       len(list_filter(text_embedding, lambda x: x > 0))::BIGINT AS nnz,
       round(list_sum(list_transform(text_embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 6) AS sumsq,
       round(list_sum(list_transform(range(len(text_embedding)), lambda i: CAST(text_embedding[i + 1] AS DOUBLE) * (i + 1))), 6) AS wsum
FROM temb""")

ORACLE["landed_manifest"] = with_ctes(MANIFEST_CTE, IMAGE_CTE, body="""
SELECT id, img, label, split FROM m
WHERE regexp_extract(img, '[^/]*$', 0) IN (SELECT filename FROM imgf)""")

ORACLE["rejected_manifest"] = with_ctes(MANIFEST_CTE, IMAGE_CTE, body="""
SELECT id, img, label, split FROM m
WHERE regexp_extract(img, '[^/]*$', 0) NOT IN (SELECT filename FROM imgf)""")

ORACLE["manifest_json"] = with_ctes(MANIFEST_CTE, body="""
SELECT id, CAST(to_json({'id': id, 'img': img, 'label': label, 'text': text}) AS VARCHAR) AS json FROM m""")

ORACLE["feature_batches"] = with_ctes(MANIFEST_CTE, body="""
SELECT id, split,
       ((row_number() OVER (PARTITION BY split ORDER BY img) - 1) // 256)::BIGINT AS batch,
       ceil(count(*) OVER (PARTITION BY split) / 256)::BIGINT AS n_batches
FROM m""")

ORACLE["stream_ingest"] = ORACLE["ingest_manifest"]

ORACLE["split_metrics"] = with_ctes(*_FZ, SCORED_CTE, body="""
SELECT split, count(*)::BIGINT AS n, sum(CASE WHEN pred = label THEN 1 ELSE 0 END)::BIGINT AS n_correct,
       round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END) * 100.0, 6) AS accuracy,
       round(avg(loss), 6) AS log_loss
FROM sl WHERE label IS NOT NULL GROUP BY split""")

ORACLE["batch_rewrite"] = with_ctes(MANIFEST_CTE, body="""
SELECT id, img, split, ((row_number() OVER (PARTITION BY split ORDER BY img) - 1) // 256)::BIGINT AS batch
FROM m""")

ORACLE["wordvec_parse"] = with_ctes(MANIFEST_CTE, TEXT_EMB_CTE, WORDVEC_CTE, body="""
SELECT token, len(vector)::BIGINT AS dim, round(list_sum(CAST(vector AS DOUBLE[])), 6) AS vsum FROM wv""")

ORACLE["split_roundtrip"] = with_ctes(MANIFEST_CTE, body="SELECT id, img, label, split FROM m WHERE split = 'dev'")

ORACLE["manifest_roundtrip"] = ORACLE["ingest_manifest"]

ORACLE["weighted_log_loss"] = with_ctes(*_FZ, SCORED_CTE, body="""
, c AS (SELECT label, count(*) AS n FROM sl WHERE split = 'train' AND label IN (0, 1) GROUP BY label),
w AS (SELECT label, CASE WHEN (SELECT count(*) FROM c) < 2 THEN 1.0
                         ELSE (SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n) END AS weight FROM c)
SELECT split, count(*)::BIGINT AS n, round(sum(loss * weight) / sum(weight), 6) AS log_loss
FROM sl JOIN w ON sl.label = w.label GROUP BY split""")

ORACLE["label_gate"] = with_ctes(MANIFEST_CTE, body="""
SELECT split, count(*) FILTER (WHERE label < 0 OR label > 1)::BIGINT AS n_invalid, count(*)::BIGINT AS n_rows
FROM m GROUP BY split""")

ORACLE["text_limit"] = with_ctes(MANIFEST_CTE, body=f"""
, k AS (SELECT img, ({tokens_of('text')})[1:128] AS tokens FROM m),
b AS (SELECT img, ('0x' || substr(md5(t), 1, 8))::BIGINT % {TEXT_DIM} AS b, count(*) AS c
      FROM (SELECT img, unnest(tokens) AS t FROM k) GROUP BY ALL)
SELECT k.img, round(coalesce(sum(CAST(CAST(b.c / len(k.tokens) AS FLOAT) AS DOUBLE) * (b.b + 1)), 0.0), 6) AS wsum
FROM k LEFT JOIN b ON k.img = b.img GROUP BY k.img""")

ORACLE["scaler_reload"] = with_ctes(*_FZ, SCALED_CTE, body="""
SELECT filename, split, round(sum(z * (i + 1)), 6) AS wsum FROM z GROUP BY filename, split""")

ORACLE["npy_roundtrip"] = with_ctes(IMAGE_CTE, body="""
SELECT filename, label, split, 'batch_' || ((row_number() OVER (PARTITION BY split ORDER BY filename) - 1) // 500) AS batch,
       len(resnet_features)::BIGINT AS width,
       round(list_sum(list_transform(range(len(resnet_features)), lambda i: CAST(resnet_features[i + 1] AS DOUBLE) * (i + 1))), 6) AS wsum
FROM imgf""")

ORACLE["image_read"] = with_ctes(IMAGE_CTE, body="""
SELECT filename, label, CAST(split_part(filename, '.', 1) AS BIGINT) % 10 <> 3 AS decoded
FROM imgf WHERE CAST(split_part(filename, '.', 1) AS BIGINT) % 10 <> 4""")

ORACLE["image_encode"] = with_ctes(IMAGE_CTE, body="""
SELECT filename, label,
       round(list_sum(list_transform(range(64), lambda i: greatest(0.0, least(255.0, floor(128 + 256 * CAST(resnet_features[i + 1] AS DOUBLE)))) * 6 * (i + 1))), 6) AS wsum
FROM imgf WHERE CAST(split_part(filename, '.', 1) AS BIGINT) % 10 NOT IN (3, 4)""")

ORACLE["score_stream"] = with_ctes(IMAGE_CTE, body="""
SELECT filename, CAST(list_sum(CAST(resnet_features AS DOUBLE[])) > 0 AS INTEGER) AS predicted_label FROM imgf""")

ORACLE["published_scores"] = ORACLE["score_stream"] + " WHERE split = 'test'"

ORACLE["csv_predictions"] = ORACLE["argmax_predictions"]

ORACLE["split_presence"] = with_ctes(MANIFEST_CTE, body="""
SELECT s.split, count(m.id) > 0 AS passes, count(m.id)::BIGINT AS n_rows, count(m.label)::BIGINT AS n_labelled
FROM (VALUES ('train'), ('dev'), ('test'), ('holdout')) s(split) LEFT JOIN m ON m.split = s.split GROUP BY s.split""")

ORACLE["fuse_colocated"] = ORACLE["fuse_concat"]

ORACLE["smote_descent"] = with_ctes(*_FZ, body="""
, c AS (SELECT label, count(*) AS n FROM fz WHERE split = 'train' GROUP BY label)
SELECT CAST(label AS INTEGER) AS label, (SELECT max(n) FROM c)::BIGINT AS n, ((SELECT max(n) FROM c) - n)::BIGINT AS n_synthetic FROM c""")
