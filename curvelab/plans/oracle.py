"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement runs on the pre-registered views of the given tables and
returns the same column names as the Spark query of the same key.  The SVM
statements spell out iterations 1 and 2 of the update rule as CTEs:
``w1 = avg(ys * x)``; ``w2 = w1 * (1 - st * 0.01) + st * sum_active(ys * x) / n``
with ``st = 1 / sqrt(2)``.
"""

from __future__ import annotations

PUBLISHED_SIZES = [3, 5, 7, 10, 13, 16, 20, 25, 30, 40, 50, 60, 70, 80, 90, 100]

CLASS_ROWS = """
class_rows AS (
  SELECT vec_id, label, 'breed_' || chr(97 + label) AS class_name,
         row_number() OVER (PARTITION BY label ORDER BY vec_id) AS num,
         CAST(embedding AS DOUBLE[]) AS features
  FROM embeddings)"""

QUANT = "list_transform(features, lambda x: CAST(round(x * 1000000.0) AS BIGINT))"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _ratio(num: str, den: str, decimals: int, scale: int = 1) -> str:
    unit = scale * 10 ** decimals
    return (f"CASE WHEN ({den}) > 0 THEN CAST((CAST({2 * unit} AS BIGINT) * ({num}) + ({den})) // (2 * ({den})) "
            f"AS BIGINT) / CAST({10 ** decimals} AS DOUBLE) END")


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def _lit(v) -> str:
    if v is None:
        return "CAST(NULL AS VARCHAR)"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(int(v))


def _models_cte(specs) -> str:
    """specs: (task_type, class_a, class_b, size, iters)."""
    rows = [(i,) + tuple(s) for i, s in enumerate(specs)]
    return f"models AS (SELECT * FROM {_values(rows, ['mid', 'task_type', 'class_a', 'class_b', 'size', 'iters'])})"


def _svm_ctes(iters: int) -> list[str]:
    """CTEs ending in ``w`` (mid, dim, w) for 1 or 2 iterations, plus ``ntr`` (mid, n)."""
    ctes = [
        """tr AS (
  SELECT m.mid, r.vec_id, r.features,
         CASE WHEN r.class_name = m.class_a THEN -1.0 ELSE 1.0 END AS ys
  FROM models m JOIN class_rows r
    ON r.num <= m.size AND (m.task_type = '1vsall' OR r.class_name = m.class_a OR r.class_name = m.class_b))""",
        """trx AS (
  SELECT mid, vec_id, ys, unnest(features) AS x, generate_subscripts(features, 1) AS dim FROM tr)""",
        "ntr AS (SELECT mid, count(*) AS n FROM tr GROUP BY mid)",
        "w1 AS (SELECT mid, dim, avg(ys * x) AS w FROM trx GROUP BY mid, dim)",
    ]
    if iters == 1:
        ctes.append("w AS (SELECT * FROM w1)")
    elif iters == 2:
        ctes += [
            """m1 AS (
  SELECT t.mid, t.vec_id, t.ys, sum(t.x * w1.w) AS margin
  FROM trx t JOIN w1 ON t.mid = w1.mid AND t.dim = w1.dim GROUP BY t.mid, t.vec_id, t.ys)""",
            """g2 AS (
  SELECT t.mid, t.dim, sum(CASE WHEN m1.ys * m1.margin < 1.0 THEN t.ys * t.x ELSE 0.0 END) AS s
  FROM trx t JOIN m1 ON t.mid = m1.mid AND t.vec_id = m1.vec_id GROUP BY t.mid, t.dim)""",
            """w AS (
  SELECT w1.mid, w1.dim,
         w1.w * (1.0 - (1.0 / sqrt(2.0)) * 0.01) - (1.0 / sqrt(2.0)) * ((-g2.s) / ntr.n) AS w
  FROM w1 JOIN g2 ON w1.mid = g2.mid AND w1.dim = g2.dim JOIN ntr ON w1.mid = ntr.mid)""",
        ]
    else:
        raise ValueError("oracle SQL covers 1 or 2 iterations")
    return ctes


def _svm_recursive_ctes(tol: float = 0.001) -> list[str]:
    """Any number of iterations (the ``iters`` column of ``models``) with the stop
    rule, as one recursive CTE carrying each model's weight list; ends in ``w``
    (mid, dim, w), ``ntr`` (mid, n) and ``wl`` (mid, w list, iters_run)."""
    return [
        """tr AS (
  SELECT m.mid, r.vec_id, r.features,
         CASE WHEN r.class_name = m.class_a THEN -1.0 ELSE 1.0 END AS ys
  FROM models m JOIN class_rows r
    ON r.num <= m.size AND (m.task_type = '1vsall' OR r.class_name = m.class_a OR r.class_name = m.class_b))""",
        "ntr AS (SELECT mid, count(*) AS n FROM tr GROUP BY mid)",
        f"""it(mid, i, w, done) AS (
  SELECT mid, 0, list_transform(range((SELECT max(len(features)) FROM class_rows)), lambda k: 0.0::DOUBLE), false
  FROM models
  UNION ALL
  SELECT mid, i, w,
         i >= 2 AND sqrt(list_sum(list_transform(list_zip(w, w_old), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))
             < {tol} * greatest(sqrt(list_sum(list_transform(w, lambda v: v * v))), 1.0)
  FROM (
    SELECT s.mid, s.i + 1 AS i, s.w AS w_old,
           list_transform(list_zip(s.w, g.s), lambda p: p[1] * (1.0 - (1.0 / sqrt(s.i + 1.0)) * 0.01)
                                                  - (1.0 / sqrt(s.i + 1.0)) * ((-p[2]) / ntr.n)) AS w
    FROM it s
    JOIN (SELECT t.mid,
                 list_reduce(list(list_transform(t.features, lambda x:
                     CASE WHEN t.ys * list_dot_product(t.features, s2.w) < 1.0 THEN t.ys * x ELSE 0.0 END)),
                   lambda a, b: list_transform(list_zip(a, b), lambda p: p[1] + p[2])) AS s
          FROM tr t JOIN it s2 ON s2.mid = t.mid GROUP BY t.mid) g ON g.mid = s.mid
    JOIN ntr ON ntr.mid = s.mid JOIN models m ON m.mid = s.mid
    WHERE s.i < m.iters AND NOT s.done))""",
        "wl AS (SELECT mid, arg_max(w, i) AS w, max(i) AS iters_run FROM it GROUP BY mid)",
        """w AS (SELECT mid, unnest(w) AS w, generate_subscripts(w, 1) AS dim FROM wl)""",
    ]


def _score_ctes(split: str = "test") -> list[str]:
    cmp = ">" if split == "test" else "<="
    return [
        f"""te AS (
  SELECT m.mid, r.vec_id, r.class_name, r.features,
         CASE WHEN r.class_name = m.class_a THEN 0 ELSE 1 END AS label
  FROM models m JOIN class_rows r
    ON r.num {cmp} m.size AND (m.task_type = '1vsall' OR r.class_name = m.class_a OR r.class_name = m.class_b))""",
        """tex AS (
  SELECT mid, vec_id, label, unnest(features) AS x, generate_subscripts(features, 1) AS dim FROM te)""",
        """mt AS (
  SELECT t.mid, t.vec_id, t.label, sum(t.x * w.w) AS margin
  FROM tex t LEFT JOIN w ON t.mid = w.mid AND t.dim = w.dim GROUP BY t.mid, t.vec_id, t.label)""",
        """sc AS (
  SELECT mid, count(*) AS n_test,
         CAST(sum(CASE WHEN (CASE WHEN margin > 0 THEN 1 ELSE 0 END) <> label THEN 1 ELSE 0 END) AS BIGINT) AS n_wrong,
         CAST(sum(label) AS BIGINT) AS n_pos
  FROM mt GROUP BY mid)""",
    ]


def _curve_sql(specs, iters: int, tol: float = 0.001, base: tuple = None) -> str:
    base = base or (CLASS_ROWS,)
    if iters in (1, 2):
        body = _with(*base, _models_cte(specs), *_svm_ctes(iters), *_score_ctes("test"))
    else:
        body = "WITH RECURSIVE " + _with(*base, _models_cte(specs), *_svm_recursive_ctes(tol),
                                         *_score_ctes("test"))[len("WITH "):]
    n_test, n_pos = "coalesce(sc.n_test, 0)", "coalesce(sc.n_pos, 0)"
    n_wrong = "CASE WHEN ntr.n IS NOT NULL THEN coalesce(sc.n_wrong, 0) END"
    return body + f"""SELECT m.task_type, m.class_a, m.class_b, CAST(m.size AS INTEGER) AS size,
       CAST(m.iters AS INTEGER) AS iters, CAST(coalesce(ntr.n, 0) AS BIGINT) AS n_train,
       CAST({n_test} AS BIGINT) AS n_test, CAST({n_wrong} AS BIGINT) AS n_wrong,
       {_ratio(n_wrong, n_test, 6)} AS error_rate,
       {_ratio(f'{n_test} - ({n_wrong})', n_test, 2, 100)} AS success_pct,
       {_ratio(f'greatest({n_pos}, {n_test} - {n_pos})', n_test, 2, 100)} AS majority_pct
FROM models m LEFT JOIN ntr ON m.mid = ntr.mid LEFT JOIN sc ON m.mid = sc.mid"""


CLASSES = [f"breed_{chr(97 + i)}" for i in range(10)]

# Hashed character trigrams of the whole lower-cased text without line breaks:
# key = (c0 << 42) xor (c1 << 21) xor c2, bucket = ((key * M) mod 2^64 >> 40) mod 256,
# counts scaled to unit length (same fixed values as the Spark featurizer).
TRIGRAM_COUNTS = r"""
tg_cp AS (
  SELECT doc_id, list_transform(string_split(regexp_replace(lower(text), '[\n\r\x{0085}\x{2028}\x{2029}]', '', 'g'), ''),
                                lambda c: CAST(unicode(c) AS BIGINT)) AS cp
  FROM documents),
tg_key AS (
  SELECT doc_id, unnest(list_transform(range(1, len(cp) - 1),
                                       lambda i: xor(xor(cp[i] << 42, cp[i + 1] << 21), cp[i + 2]))) AS key
  FROM tg_cp WHERE len(cp) >= 3),
tg_cnt AS (
  SELECT doc_id, CAST(((CAST(key AS HUGEINT) * CAST('11400714819323198485' AS HUGEINT))
                        % CAST('18446744073709551616' AS HUGEINT)) // CAST(1099511627776 AS HUGEINT) AS BIGINT) % 256 AS bucket,
         count(*) AS n
  FROM tg_key GROUP BY ALL),
tg_val AS (
  SELECT c.doc_id, c.bucket, c.n / sqrt(z.s) AS v
  FROM tg_cnt c JOIN (SELECT doc_id, sum(n * n) AS s FROM tg_cnt GROUP BY doc_id) z ON c.doc_id = z.doc_id)"""

TRIGRAM_VECTORS = TRIGRAM_COUNTS + r""",
tg_vec AS (
  SELECT d.doc_id, list(coalesce(v.v, 0.0) ORDER BY r.b) AS features
  FROM documents d CROSS JOIN range(0, 256) AS r(b)
  LEFT JOIN tg_val v ON v.doc_id = d.doc_id AND v.bucket = r.b
  GROUP BY d.doc_id)"""

LANG_ROWS = TRIGRAM_VECTORS + """,
class_rows AS (
  SELECT d.doc_id AS vec_id, d.lang AS class_name,
         row_number() OVER (PARTITION BY d.lang ORDER BY d.doc_id) AS num, t.features
  FROM documents d JOIN tg_vec t ON t.doc_id = d.doc_id)"""

QUALITY_ROWS = TRIGRAM_VECTORS + """,
class_rows AS (
  SELECT d.doc_id AS vec_id, 'q' || CAST(l.quality AS VARCHAR) AS class_name,
         row_number() OVER (PARTITION BY l.quality ORDER BY d.doc_id) AS num, t.features
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id JOIN tg_vec t ON t.doc_id = d.doc_id)"""

LANG_SIZES = [3, 5, 10, 16]


def _vall(classes, sizes, iters):
    return [("1vsall", c, None, s, iters) for c in classes for s in sizes]


def _weights_sql(specs, iters: int) -> str:
    return _with(CLASS_ROWS, _models_cte(specs), *_svm_ctes(iters)) + """SELECT m.task_type, m.class_a, m.class_b,
       CAST(m.size AS INTEGER) AS size, CAST(m.iters AS INTEGER) AS iters, CAST(w.dim AS INTEGER) AS dim,
       round(w.w, 6) AS weight
FROM models m JOIN w ON m.mid = w.mid"""


def _pair_pred_ctes() -> list[str]:
    specs = [("1vs1", "breed_a", "breed_b", 10, 1)]
    return [CLASS_ROWS, _models_cte(specs), *_svm_ctes(1), """pred AS (
  SELECT r.vec_id, r.class_name, CAST(CASE WHEN r.class_name = 'breed_a' THEN 0.0 ELSE 1.0 END AS DOUBLE) AS label,
         CAST(CASE WHEN sum(x.x * w.w) > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction
  FROM (SELECT vec_id, class_name, unnest(features) AS x, generate_subscripts(features, 1) AS dim
        FROM class_rows WHERE class_name IN ('breed_a', 'breed_b') AND num > 10) x
  JOIN class_rows r ON r.vec_id = x.vec_id
  JOIN w ON w.dim = x.dim
  GROUP BY r.vec_id, r.class_name)"""]


def _error_counts(src: str) -> str:
    n, wr = "count(*)", "CAST(coalesce(sum(CASE WHEN label <> prediction THEN 1 ELSE 0 END), 0) AS BIGINT)"
    return f"""SELECT CAST({n} AS BIGINT) AS n_rows, {wr} AS n_wrong,
       {_ratio(wr, n, 6)} AS error_rate, {_ratio(f'{n} - {wr}', n, 2, 100)} AS success_pct
FROM {src}"""


def _summary(col: str = "features") -> str:
    return (f"CAST(len({col}) AS INTEGER) AS n_dims, CAST(list_sum({col}) AS BIGINT) AS sum_q, "
            f"CAST({col}[1] AS BIGINT) AS first_q, CAST({col}[len({col})] AS BIGINT) AS last_q")


TRAINED_KEYS = [
    ("1vsall", "breed_a", None, 3, 10),
    ("1vsall", "breed_b", None, 3, 100),
    ("1vsall", "breed_c", None, 5, 10),
    ("1vs1", "breed_a", "breed_b", 3, 10),
]


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["class_rows"] = _with(CLASS_ROWS) + "SELECT vec_id, class_name, num FROM class_rows"
    q["base_name"] = _with(CLASS_ROWS) + """SELECT vec_id, path, split_part(path, '/', -1) AS base_name
FROM (SELECT vec_id, 'images/' || class_name || '_' || CAST(num AS VARCHAR) || '.jpg' AS path FROM class_rows)"""
    first_digit = r"nullif(regexp_extract({0}, '^(\D*)\D\d', 1), '')"
    q["class_from_first_digit"] = _with(CLASS_ROWS) + f"""SELECT vec_id, file_name,
       {first_digit.format('file_name')} AS class_name,
       {first_digit.format("CAST(num AS VARCHAR) || '_' || class_name || '.json'")} AS class_digit_first,
       {first_digit.format("class_name || '.json'")} AS class_no_digit
FROM (SELECT *, class_name || '_' || CAST(num AS VARCHAR) || '.jpg.json' AS file_name FROM class_rows)"""
    cn = r"'^(.*)_([0-9]+)[.]jpg$'"
    q["class_and_num"] = _with(CLASS_ROWS) + f"""SELECT vec_id,
       nullif(regexp_extract(good, {cn}, 1), '') AS class_name,
       TRY_CAST(nullif(regexp_extract(good, {cn}, 2), '') AS BIGINT) AS num,
       nullif(regexp_extract(nosep, {cn}, 1), '') AS nosep_class,
       TRY_CAST(nullif(regexp_extract(nosep, {cn}, 2), '') AS BIGINT) AS nosep_num,
       nullif(regexp_extract(png, {cn}, 1), '') AS png_class
FROM (SELECT vec_id,
             class_name || '_' || CAST(num AS VARCHAR) || '.jpg' AS good,
             class_name || CAST(num AS VARCHAR) || '.jpg' AS nosep,
             class_name || '_' || CAST(num AS VARCHAR) || '.png' AS png
      FROM class_rows)"""
    q["feature_line_roundtrip"] = _with(CLASS_ROWS) + f"""SELECT vec_id, trim(parts[1]) AS class_name,
       TRY_CAST(trim(parts[2]) AS BIGINT) AS num, {_summary('f')}
FROM (SELECT vec_id, parts,
             list_transform(list_slice(parts, 3, len(parts)), lambda x: CAST(trim(x) AS DOUBLE)) AS f
      FROM (SELECT vec_id, string_split(line, ',') AS parts
            FROM (SELECT vec_id, class_name || ',' || CAST(num AS VARCHAR) || ',' ||
                         array_to_string(list_transform({QUANT}, lambda v: CAST(v AS VARCHAR)), ', ') AS line
                  FROM class_rows)))"""
    q["feature_json_parse"] = _with(CLASS_ROWS) + f"""SELECT vec_id, file_name,
       nullif(regexp_extract(stem, {cn}, 1), '') AS class_name,
       TRY_CAST(nullif(regexp_extract(stem, {cn}, 2), '') AS BIGINT) AS num,
       {first_digit.format('file_name')} AS class_first_digit, {_summary('f')}
FROM (SELECT vec_id, file_name, regexp_replace(file_name, '[.]json$', '') AS stem,
             CAST(value AS DOUBLE[]) AS f
      FROM (SELECT vec_id, class_name || '_' || CAST(num AS VARCHAR) || '.jpg.json' AS file_name,
                   '[' || array_to_string(list_transform({QUANT}, lambda v: CAST(v AS VARCHAR)), ', ') || ']' AS value
            FROM class_rows))"""
    q["labeled_line_parse"] = _with(CLASS_ROWS) + f"""SELECT vec_id, TRY_CAST(trim(parts[1]) AS DOUBLE) AS label, {_summary('f')}
FROM (SELECT vec_id, parts,
             list_transform(list_slice(parts, 2, len(parts)), lambda x: CAST(trim(x) AS DOUBLE)) AS f
      FROM (SELECT vec_id, string_split(CAST(label AS VARCHAR) || ',' ||
                   array_to_string(list_transform({QUANT}, lambda v: CAST(v AS VARCHAR)), ','), ',') AS parts
            FROM class_rows))"""
    q["count_rows"] = _with(CLASS_ROWS) + "SELECT count(*) AS n_rows FROM class_rows"
    q["check_classes"] = _with(CLASS_ROWS) + \
        "SELECT class_name, count(*) AS n_rows FROM class_rows WHERE class_name IN ('breed_b', 'breed_i') GROUP BY class_name"
    q["featurize_model"] = """SELECT vec_id, CAST(b + 1 AS INTEGER) AS dim, round(sum(CAST(x AS DOUBLE)), 6) AS value
FROM (SELECT vec_id, unnest(embedding) AS x, (generate_subscripts(embedding, 1) - 1) // 8 AS b FROM embeddings)
GROUP BY vec_id, b"""
    q["skip_if_featurized"] = """SELECT d.doc_id, d.lang FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""
    q["class_counts"] = _with(CLASS_ROWS) + "SELECT class_name, count(*) AS n_rows FROM class_rows GROUP BY class_name"
    q["split_threshold"] = _with(CLASS_ROWS) + """SELECT vec_id, class_name, num,
       CASE WHEN num <= 10 THEN 'train' ELSE 'test' END AS split FROM class_rows"""
    q["split_quota"] = _with(CLASS_ROWS) + f"""SELECT vec_id, class_name, file_name,
       CASE WHEN row_number() OVER (PARTITION BY class_name ORDER BY file_name) <= 7 THEN 'train' ELSE 'test' END AS split
FROM (SELECT vec_id, file_name, {first_digit.format('file_name')} AS class_name
      FROM (SELECT vec_id, class_name || '_' || CAST(num AS VARCHAR) || '.jpg.json' AS file_name FROM class_rows))"""
    q["filter_two_classes"] = _with(CLASS_ROWS) + \
        "SELECT vec_id, class_name FROM class_rows WHERE class_name IN ('breed_c', 'breed_g')"
    q["label_1v1"] = _with(CLASS_ROWS) + """SELECT vec_id, class_name,
       CAST(CASE WHEN class_name = 'breed_c' THEN 0.0 ELSE 1.0 END AS DOUBLE) AS label
FROM class_rows WHERE class_name IN ('breed_c', 'breed_g')"""
    q["label_1vall"] = _with(CLASS_ROWS) + """SELECT vec_id, class_name,
       CAST(CASE WHEN class_name = 'breed_e' THEN 0.0 ELSE 1.0 END AS DOUBLE) AS label FROM class_rows"""
    label_map = """lm AS (SELECT class_name, CAST(dense_rank() OVER (ORDER BY class_name) - 1 AS INTEGER) AS label_idx
       FROM (SELECT DISTINCT class_name FROM class_rows WHERE class_name IS NOT NULL))"""
    q["label_index"] = _with(CLASS_ROWS, label_map) + \
        "SELECT r.vec_id, r.class_name, lm.label_idx FROM class_rows r LEFT JOIN lm ON r.class_name = lm.class_name"
    q["label_decode"] = _with(CLASS_ROWS, label_map) + """SELECT r.vec_id, CAST(lm.label_idx AS DOUBLE) AS prediction,
       d.class_name AS predicted_class
FROM class_rows r LEFT JOIN lm ON r.class_name = lm.class_name LEFT JOIN lm d ON d.label_idx = lm.label_idx"""
    q["label_index_appended"] = _with(CLASS_ROWS) + """SELECT vec_id, class_name,
       CAST(dense_rank() OVER (ORDER BY CASE WHEN class_name IN ('breed_c', 'breed_f', 'breed_h') THEN 1
         WHEN class_name <> 'breed_a' THEN 2 ELSE 3 END, class_name) - 1 AS INTEGER) AS label_idx
FROM class_rows"""
    q["featurize_failures"] = """SELECT vec_id, CASE WHEN vec_id % 13 <> 5 THEN CAST(vec_id AS DOUBLE) END AS value,
       CASE WHEN vec_id % 13 = 5 THEN 'ValueError: invalid literal for int() with base 10: ''broken''' END AS reason
FROM embeddings"""
    sizes = _values([(s,) for s in PUBLISHED_SIZES], ["size"])
    q["sweep_rows"] = _with(CLASS_ROWS) + f"""SELECT CAST(c.size AS INTEGER) AS size, c.class_name, sp.split,
       CAST(CASE WHEN sp.split = 'train' THEN c.n_train ELSE c.n_total - c.n_train END AS BIGINT) AS n_rows
FROM (SELECT t.size, r.class_name, count(*) AS n_total,
             sum(CASE WHEN r.num <= t.size THEN 1 ELSE 0 END) AS n_train
      FROM class_rows r CROSS JOIN {sizes} GROUP BY t.size, r.class_name) c
CROSS JOIN (VALUES ('train'), ('test')) AS sp(split)"""
    q["svm_weights_1iter"] = _weights_sql(_vall(CLASSES, [3, 10], 1), 1)
    q["svm_weights_2iter"] = _weights_sql(
        _vall(CLASSES, [3, 10], 2) + [("1vs1", "breed_a", "breed_b", s, 2) for s in (5, 20)], 2
    )
    q["svm_predict"] = _with(*_pair_pred_ctes()) + "SELECT vec_id, label, prediction FROM pred"
    q["misclassified"] = _with(*_pair_pred_ctes()) + "SELECT vec_id, class_name FROM pred WHERE label <> prediction"
    q["error_rate"] = _with(*_pair_pred_ctes()) + _error_counts("pred")
    q["training_error"] = _with(
        CLASS_ROWS, _models_cte([("1vsall", "breed_d", None, 20, 1)]), *_svm_ctes(1),
        """pred AS (
  SELECT x.vec_id, CAST(CASE WHEN x.class_name = 'breed_d' THEN 0.0 ELSE 1.0 END AS DOUBLE) AS label,
         CAST(CASE WHEN sum(x.x * w.w) > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction
  FROM (SELECT vec_id, class_name, unnest(features) AS x, generate_subscripts(features, 1) AS dim
        FROM class_rows WHERE num <= 20) x JOIN w ON w.dim = x.dim
  GROUP BY x.vec_id, x.class_name)""",
    ) + _error_counts("pred")
    q["training_error_fit"] = _with(
        CLASS_ROWS, _models_cte(_vall(CLASSES, [3, 20], 1)), *_svm_ctes(1),
        """pred AS (
  SELECT m.class_a, m.size, x.vec_id, (sum(x.x * w.w) > 0) <> (x.class_name <> m.class_a) AS wrong
  FROM (SELECT vec_id, class_name, num, unnest(features) AS x, generate_subscripts(features, 1) AS dim FROM class_rows) x
  JOIN w ON w.dim = x.dim JOIN models m ON m.mid = w.mid AND x.num <= m.size
  GROUP BY m.class_a, m.size, x.vec_id, x.class_name)""",
        """counted AS (
  SELECT class_a, CAST(size AS INTEGER) AS size, count(*) AS n_train, CAST(sum(CAST(wrong AS INTEGER)) AS BIGINT) AS n_wrong
  FROM pred GROUP BY class_a, size)""",
    ) + f"SELECT class_a, size, n_train, n_wrong, {_ratio('n_wrong', 'n_train', 6)} AS error_rate FROM counted"
    q["success_pct"] = (
        "SELECT class_a, n_test, n_wrong, success_pct FROM ("
        + _curve_sql(_vall(CLASSES, [10], 1), 1) + ")"
    )
    q["eval_1v1"] = _curve_sql([("1vs1", "breed_a", "breed_b", 10, 1)], 1)
    q["eval_1vall"] = _curve_sql([("1vsall", "breed_e", None, 7, 1)], 1)
    q["learning_curve_1v1"] = _curve_sql([("1vs1", "breed_c", "breed_h", s, 2) for s in PUBLISHED_SIZES], 2)
    q["learning_curve_1vall"] = _curve_sql(_vall(CLASSES, PUBLISHED_SIZES, 2), 2)
    q["learning_curve_iterative"] = q["learning_curve_1vall"]
    q["learning_curve_1vall_100"] = _curve_sql(_vall(CLASSES, PUBLISHED_SIZES, 100), 100)
    q["learning_curve_1v1_100"] = _curve_sql([("1vs1", "breed_c", "breed_h", s, 100) for s in PUBLISHED_SIZES], 100)
    q["curve_1vall_gram"] = _curve_sql(_vall(CLASSES, [3, 10], 100), 100)
    q["learning_curve_iterative_100"] = q["learning_curve_1vall_100"]
    stop_specs = [("1vsall", c, None, s, 100) for c in ("breed_a", "breed_f") for s in (5, 30)]
    stop_specs += [("1vs1", "breed_b", "breed_c", 20, 100)]
    q["svm_weights_stop"] = "WITH RECURSIVE " + _with(
        CLASS_ROWS, _models_cte(stop_specs), *_svm_recursive_ctes(0.05))[len("WITH "):] + """SELECT m.task_type,
       m.class_a, m.class_b, CAST(m.size AS INTEGER) AS size, CAST(m.iters AS INTEGER) AS iters,
       CAST(wl.iters_run AS INTEGER) AS iters_run, CAST(w.dim AS INTEGER) AS dim, round(w.w, 6) AS weight
FROM models m JOIN wl ON m.mid = wl.mid JOIN w ON m.mid = w.mid"""
    # M7: quota split of 10 files per class (file names carry the ordinal, so the
    # first 10 by (number, name) are num <= 10); 20 iterations; training error
    local_specs = _vall(CLASSES, [10], 20)
    q["train_local"] = "WITH RECURSIVE " + _with(
        CLASS_ROWS, _models_cte(local_specs), *_svm_recursive_ctes(), *_score_ctes("train"))[len("WITH "):] + f"""SELECT
       m.task_type, m.class_a, m.class_b, CAST(m.size AS INTEGER) AS size, CAST(m.iters AS INTEGER) AS iters,
       CAST(coalesce(sc.n_test, 0) AS BIGINT) AS n_train, CAST(coalesce(sc.n_wrong, 0) AS BIGINT) AS n_wrong,
       {_ratio('coalesce(sc.n_wrong, 0)', 'coalesce(sc.n_test, 0)', 6)} AS error_rate
FROM models m LEFT JOIN sc ON m.mid = sc.mid"""
    # M8: the saved 1 vs 1 model of that run against the held-out files
    q["saved_model_test"] = "WITH RECURSIVE " + _with(
        CLASS_ROWS, _models_cte([("1vs1", "breed_a", "breed_b", 10, 20)]), *_svm_recursive_ctes(),
        *_score_ctes("test"))[len("WITH "):] + f"""SELECT CAST(sc.n_test AS BIGINT) AS n_rows,
       CAST(sc.n_wrong AS BIGINT) AS n_wrong, {_ratio('sc.n_wrong', 'sc.n_test', 6)} AS error_rate,
       {_ratio('sc.n_test - sc.n_wrong', 'sc.n_test', 2, 100)} AS success_pct
FROM sc"""
    q["featurize_text"] = _with(TRIGRAM_COUNTS) + """SELECT doc_id, CAST(bucket + 1 AS INTEGER) AS dim,
       round(v, 6) AS value FROM tg_val"""
    langs = ["de", "en", "es", "fr"]
    q["learning_curve_lang"] = _curve_sql(_vall(langs, LANG_SIZES, 100), 100, base=(LANG_ROWS,))
    q["learning_curve_quality"] = _curve_sql([("1vs1", "q0", "q1", s, 100) for s in LANG_SIZES], 100,
                                             base=(QUALITY_ROWS,))
    q["curve_table"] = (
        "SELECT task_type, class_a, class_b, size, success_pct FROM ("
        + _curve_sql(_vall(["breed_a"], PUBLISHED_SIZES, 1), 1) + ")"
    )
    stored = _values(TRAINED_KEYS, ["task_type", "class_a", "class_b", "size", "iters"])
    q["missing_models"] = _with(CLASS_ROWS) + f"""SELECT q.task_type, q.class_a, q.class_b,
       CAST(q.size AS INTEGER) AS size, CAST(q.iters AS INTEGER) AS iters
FROM (SELECT '1vsall' AS task_type, c.class_name AS class_a, CAST(NULL AS VARCHAR) AS class_b, s.size, i.iters
      FROM (SELECT DISTINCT class_name FROM class_rows) c
      CROSS JOIN (VALUES (3), (5), (10)) AS s(size) CROSS JOIN (VALUES (10), (100)) AS i(iters)) q
WHERE NOT EXISTS (SELECT 1 FROM {stored}
                  WHERE t.task_type = q.task_type AND t.class_a IS NOT DISTINCT FROM q.class_a
                    AND t.class_b IS NOT DISTINCT FROM q.class_b AND t.size = q.size AND t.iters = q.iters)"""
    q["get_or_train"] = _with(CLASS_ROWS, _models_cte([("1vs1", "breed_a", "breed_b", s, 1) for s in (3, 5, 10)]),
                              *_svm_ctes(1)) + """SELECT m.task_type, m.class_a, m.class_b, CAST(m.size AS INTEGER) AS size,
       CAST(m.iters AS INTEGER) AS iters, CAST(ntr.n AS BIGINT) AS n_train
FROM models m JOIN ntr ON m.mid = ntr.mid"""
    q["classify_records"] = _with(CLASS_ROWS, _models_cte(_vall(CLASSES, [10], 1)), *_svm_ctes(1), """mg AS (
  SELECT x.vec_id, m.class_a, sum(x.x * w.w) AS margin
  FROM (SELECT vec_id, unnest(features) AS x, generate_subscripts(features, 1) AS dim
        FROM class_rows WHERE num > 10) x
  JOIN w ON w.dim = x.dim JOIN models m ON m.mid = w.mid
  GROUP BY x.vec_id, m.class_a)""") + "SELECT vec_id, arg_min(class_a, margin) AS predicted_class FROM mg GROUP BY vec_id"
    q["classify_sub_classes"] = """WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS features FROM embeddings),
entries AS (
  SELECT label || '_' || lpad(CAST(vec_id % 100 AS VARCHAR), 2, '0') AS class_a, unnest(features) AS x,
         generate_subscripts(features, 1) AS dim FROM whole),
sums AS (SELECT class_a, dim, sum(x) AS x, count(*) AS n FROM entries GROUP BY class_a, dim),
models AS (SELECT class_a, list(0.0 - x ORDER BY dim) AS weights, CAST(max(n) AS DOUBLE) AS intercept FROM sums GROUP BY class_a),
margins AS (
  SELECT r.vec_id, m.class_a, list_dot_product(r.features, m.weights) + m.intercept AS margin FROM whole r CROSS JOIN models m)
SELECT vec_id, class_a AS predicted_class, margin FROM margins
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY margin, class_a) = 1"""
    # M8, every class: the lowest margin names the class
    q["saved_model_test_all"] = "WITH RECURSIVE " + _with(
        CLASS_ROWS, _models_cte(local_specs), *_svm_recursive_ctes(), """mg AS (
  SELECT x.vec_id, x.class_name, m.class_a, sum(x.x * w.w) AS margin
  FROM (SELECT vec_id, class_name, unnest(features) AS x, generate_subscripts(features, 1) AS dim
        FROM class_rows WHERE num > 10) x
  JOIN w ON w.dim = x.dim JOIN models m ON m.mid = w.mid GROUP BY ALL)""",
        """pred AS (SELECT vec_id, class_name AS label, arg_min(class_a, margin) AS prediction FROM mg GROUP BY vec_id, class_name)""",
    )[len("WITH "):] + _error_counts("pred")
    gap = CLASS_ROWS.replace("class_rows AS (", "all_rows AS (") + ",\nclass_rows AS (SELECT * FROM all_rows WHERE num >= 41)"
    q["learning_curve_gap"] = _curve_sql(_vall(CLASSES, [3, 43], 2), 2, base=(gap,))
    q["learning_curve_gap_iterative"] = q["learning_curve_gap"]
    q["split_quota_large"] = """SELECT doc_id, lang,
       CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 1001 THEN 'train' ELSE 'test' END AS split
FROM documents"""
    q["split_quota_appended"] = """SELECT doc_id, lang,
       CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY CAST(doc_id AS VARCHAR)) <= 60 THEN 'train' ELSE 'test' END AS split
FROM documents"""
    q["feature_line_files"] = _with(CLASS_ROWS) + f"""SELECT class_name, num, {_summary('f')}
FROM (SELECT class_name, num, list_transform({QUANT}, lambda v: CAST(v AS DOUBLE)) AS f FROM class_rows)"""
    body = f"'[' || array_to_string(list_transform({QUANT}, lambda v: CAST(v AS VARCHAR)), ', ') || ']'"
    named = f"SELECT *, class_name || '_' || CAST(num AS VARCHAR) || '.jpg' AS file_name, {body} AS body FROM class_rows"
    q["feature_json_files"] = _with(CLASS_ROWS) + f"""SELECT file_name || '.json' AS file_name, class_name, num,
       class_name AS class_first_digit, {_summary('f')}
FROM (SELECT *, CAST(body AS DOUBLE[]) AS f FROM ({named})) WHERE class_name BETWEEN 'breed_a' AND 'breed_e'"""
    q["read_images"] = _with(CLASS_ROWS) + f"""SELECT file_name, class_name, num, CAST(strlen(body) AS BIGINT) AS length,
       md5(body) AS md5 FROM ({named})"""
    q["list_inputs"] = _with(CLASS_ROWS) + f"""SELECT file_name, CAST(strlen(body) AS BIGINT) AS length
FROM ({named}) WHERE class_name BETWEEN 'breed_f' AND 'breed_j'"""
    q["new_image_features"] = _with(CLASS_ROWS) + f"""SELECT file_name, class_name, num, CAST(strlen(body) AS BIGINT) AS n_bytes,
       CAST(list_sum(list_transform(string_split(body, ''), lambda c: unicode(c))) AS BIGINT) AS byte_sum
FROM ({named}) WHERE num % 2 = 1"""
    q["write_results"] = "SELECT task_type, class_a AS target, size, success_pct AS success FROM (" + _curve_sql(
        _vall(["breed_a", "breed_d"], [3, 10, 30], 1), 1) + ")"
    q["validate_request"] = """SELECT vec_id, CASE
    WHEN (pair IS NULL) = (target IS NULL) THEN 'either a pair or a target'
    WHEN train AND test THEN 'train, test and check are exclusive'
    WHEN pair NOT LIKE '%,%' THEN 'a pair needs two classes'
    WHEN split_part(pair, ', ', 1) = split_part(pair, ', ', 2) THEN 'a pair needs two different classes'
    WHEN vec_id % 13 = 0 THEN 'sizes must be numbers'
    WHEN vec_id % 5 = 0 THEN 'sizes must be greater than zero' END AS refused
FROM (SELECT vec_id, c,
        CASE WHEN vec_id % 3 <> 0 THEN CASE WHEN vec_id % 7 = 0 THEN c ELSE c || ', breed_' || chr(CAST(97 + vec_id % 10 AS INTEGER)) END END AS pair,
        CASE WHEN vec_id % 3 = 0 OR vec_id % 11 = 0 THEN c END AS target, vec_id % 17 = 0 AS train, vec_id % 2 = 0 AS test
      FROM (SELECT vec_id, 'breed_' || chr(97 + label) AS c FROM embeddings))"""
    q["rejected_rows"] = """SELECT vec_id, CASE WHEN vec_id % 9 = 0 THEN 'no class' WHEN vec_id % 10 = 0 THEN 'no number'
       ELSE 'vector length' END AS reason
FROM embeddings WHERE vec_id % 9 = 0 OR vec_id % 10 = 0 OR vec_id % 11 = 0"""
    return q
