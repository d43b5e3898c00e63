"""The same results in plain SQL for another engine to compute over the same tables."""

from __future__ import annotations

FEATURES = ("glucose", "glucose_ma_1h", "glucose_std_1h", "glucose_roc", "steps", "heart_rate", "hour",
            "day_of_week", "is_night", "is_weekend")
FIT = ("train_loss", "train_accuracy", "val_accuracy", "val_f1", "val_auc")


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


RAW = """raw AS (
  SELECT 'institution_' || (user_id % 3 + 1) AS institution, user_id AS series_id, event_id, ts, event_type,
         CASE WHEN event_type <> 'error' THEN value + 30.0 END AS raw_glucose,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS steps,
         CAST(60 + event_id % 60 AS INTEGER) AS heart_rate
  FROM events)"""
CLEAN = """med AS (SELECT median(raw_glucose) AS m FROM raw),
clean AS (
  SELECT raw.*, CASE WHEN coalesce(raw_glucose, m) < 40 THEN 40.0 WHEN coalesce(raw_glucose, m) > 400 THEN 400.0
                     ELSE coalesce(raw_glucose, m) END AS glucose
  FROM raw, med)"""


def rolled(source: str = "clean", series: str = "series_id", first_std: str = "NULL", glucose: str = "glucose") -> str:
    part = f"PARTITION BY {series} " if series else ""
    return f"""rolled AS (
  SELECT *, CASE WHEN n > 12 THEN avg({glucose}) OVER f ELSE {glucose} END AS glucose_ma_1h,
         CASE WHEN n > 12 THEN coalesce(stddev_samp({glucose}) OVER f, {first_std}) ELSE 0.0 END AS glucose_std_1h,
         coalesce({glucose} - lag({glucose}) OVER ({part}ORDER BY ts, event_id), 0.0) AS glucose_roc
  FROM (SELECT *, count(*) OVER ({part.strip()}) AS n FROM {source})
  WINDOW f AS ({part}ORDER BY ts, event_id ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))"""


TIMED = """timed AS (
  SELECT *, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week FROM rolled)"""
FEATURED = """feat AS (
  SELECT *, CASE WHEN glucose < 70 THEN 1 ELSE 0 END AS hypo_risk,
         CASE WHEN hour >= 22 OR hour <= 6 THEN 1 ELSE 0 END AS is_night,
         CASE WHEN day_of_week IN (5, 6) THEN 1 ELSE 0 END AS is_weekend
  FROM timed)"""
FEAT = (RAW, CLEAN, rolled(first_std="0.0"), TIMED, FEATURED)


def stats(select: str = "", group: str = "", glucose: str = "glucose", heart: str = "heart_rate") -> str:
    return f"""{select} count(*) AS total_records, round(avg({glucose}), 6) AS avg_glucose,
      min({glucose}) AS min_glucose, max({glucose}) AS max_glucose, round(stddev_samp({glucose}), 6) AS std_glucose,
      CAST(sum(hypo_risk) AS BIGINT) AS hypo_events, round(avg({heart}), 6) AS avg_heart_rate,
      CAST(sum(steps) AS BIGINT) AS total_steps FROM feat {group}"""


def scaled(deviation: str, partition: str) -> str:
    columns = ",\n    ".join(
        f"({c} - avg({c}) OVER p) / nullif({deviation}({c}) OVER p, 0) AS {c}_s" for c in FEATURES
    )
    return f"""scaled AS (
  SELECT *, {columns}
  FROM feat WINDOW p AS ({partition}))"""


SPREAD = ", ".join(f"round(coalesce({c}_s, 0.0), 6) AS {c}" for c in FEATURES)
POPULATION = scaled("stddev_pop", "PARTITION BY institution")
ML = f"{with_(*FEAT, POPULATION)} SELECT institution, event_id, {SPREAD}, hypo_risk FROM scaled"


def ranked(key: str, partition: str = "") -> str:
    return f"""keyed AS (SELECT *, md5('42:' || CAST(event_id AS VARCHAR)) AS k FROM {key}),
ranked AS (
  SELECT *, row_number() OVER ({partition} ORDER BY k, event_id) AS rn, count(*) OVER ({partition}) AS total FROM keyed)"""


SCORED = """scored AS (
  SELECT institution, hypo_risk AS label, 1.0 / (1.0 + exp(-((75.0 - floor(round(glucose_ma_1h, 6))) / 10.0))) AS p,
         -floor(round(glucose_ma_1h, 6)) AS s
  FROM feat)"""
CONFUSION = """conf AS (
  SELECT institution, count(*) AS num_examples,
         count(*) FILTER (label = 1 AND p > 0.5) AS tp, count(*) FILTER (label = 0 AND p > 0.5) AS fp,
         count(*) FILTER (label = 1 AND p <= 0.5) AS fn, count(*) FILTER (label = 0 AND p <= 0.5) AS tn,
         avg(-ln(greatest(CASE WHEN label = 1 THEN p ELSE 1 - p END, 1e-15))) AS loss
  FROM scored GROUP BY institution)"""
QUALITY = """round((tp + tn) / num_examples, 6) AS accuracy,
  round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS "precision",
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1"""
# Mean rank of the positives, ties at their average rank.
AUC = """ranks AS (
  SELECT institution, label,
         rank() OVER (PARTITION BY institution ORDER BY s)
           + (count(*) OVER (PARTITION BY institution, s) - 1) / 2.0 AS r
  FROM scored),
auc AS (
  SELECT institution, CASE WHEN min(label) = max(label) THEN 0.0 ELSE
    (sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
      / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) END AS auc
  FROM ranks GROUP BY institution)"""

CLIENTS = """clients AS (
  SELECT round, institution, num_examples, train_loss, train_accuracy,
         CASE WHEN NOT (institution = 'institution_2' AND round % 2 = 0) THEN night END AS val_f1,
         CASE WHEN NOT (institution = 'institution_1' AND round % 7 = 0) THEN night / 2 + 0.25 END AS val_auc,
         CASE WHEN round % 5 <> 0 THEN round(1 - night, 1) END AS val_accuracy
  FROM (SELECT day(ts) AS round, institution, count(*) AS num_examples, avg(glucose) / 100 AS train_loss,
               avg(1.0 - hypo_risk) AS train_accuracy, avg(is_night) AS night
        FROM feat GROUP BY ALL)),
globals AS (
  SELECT day(ts) AS round, institution, count(*) AS num_examples, avg(is_night) AS accuracy, avg(hypo_risk) AS f1,
         avg(hypo_risk) / 2 AS auc
  FROM feat GROUP BY ALL)"""


def weighted(name: str, source: str, metrics: tuple[str, ...], where: str = "true") -> str:
    means = ",\n    ".join(
        f"""CASE WHEN bool_or(institution = first_client AND {m} IS NOT NULL)
         THEN coalesce(sum(num_examples * {m}), 0) / sum(num_examples) END AS {m}""" for m in metrics
    )
    return f"""{name} AS (
  SELECT round, CAST(sum(num_examples) AS BIGINT) AS num_examples, {means}
  FROM (SELECT *, min(institution) OVER (PARTITION BY round) AS first_client FROM {source} WHERE {where})
  GROUP BY round)"""


HISTORY = (
    weighted("fit", "clients", FIT, "round % 6 <> 3"),
    weighted("ev", "globals", ("accuracy", "f1", "auc"), "round % 4 <> 0"),
    """hist AS (
  SELECT coalesce(fit.round, ev.round) AS round, train_loss, train_accuracy, CAST(NULL AS DOUBLE) AS val_loss,
         coalesce(val_accuracy, accuracy) AS val_accuracy, coalesce(val_f1, f1) AS val_f1, coalesce(val_auc, auc) AS val_auc
  FROM fit FULL OUTER JOIN ev ON fit.round = ev.round)""",
)
HISTORY_COLUMNS = ("train_loss", "train_accuracy", "val_loss", "val_accuracy", "val_f1", "val_auc")
HISTORY_WIDE = with_(*FEAT, CLIENTS, *HISTORY) + " SELECT CAST(round AS BIGINT) AS round, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in HISTORY_COLUMNS
) + " FROM hist"

def drawn(seed: str) -> str:
    """The number of the first eight hexadecimal digits of a row's hash."""
    return " + ".join(f"(strpos('0123456789abcdef', substr(md5('{seed}:' || event_id), {k + 1}, 1)) - 1) * {16 ** (7 - k)}::BIGINT" for k in range(8))


PARAM_COLUMNS = ("glucose", "glucose_ma_1h", "glucose_std_1h", "glucose_roc", "steps", "heart_rate")
PARAMS = "params AS (SELECT institution, count(*) AS n, " + ", ".join(
    f"avg({c}) AS p{i}" for i, c in enumerate(PARAM_COLUMNS)
) + " FROM feat GROUP BY institution)"


def averaged(expression: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS pos, round({expression.format(p=f'p{i}')}, 6) AS value FROM params"
        for i in range(len(PARAM_COLUMNS))
    )
    return f"{with_(*FEAT, PARAMS)} {rows}"


def logistic_rounds(rounds: int = 3, rate: float = 0.5) -> str:
    """Gradient steps unrolled: each round's local models are averaged into the next round's start."""
    xs = [f"coalesce({c}_s, 0.0)" for c in FEATURES]
    parts = [*FEAT, POPULATION, "data AS (SELECT institution, hypo_risk AS y, " + ", ".join(
        f"{x} AS x{i}" for i, x in enumerate(xs)
    ) + ", 1.0::DOUBLE AS x10 FROM scaled)", "g0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS w{i}" for i in range(11)) + ")"]
    for r in range(1, rounds + 1):
        z = " + ".join(f"w{i} * x{i}" for i in range(11))
        parts.append(f"e{r} AS (SELECT data.*, g.*, 1.0 / (1.0 + exp(-({z}))) - y AS e FROM data, g{r - 1} g)")
        parts.append(f"l{r} AS (SELECT institution, count(*) AS n, " + ", ".join(
            f"min(w{i}) - {rate}::DOUBLE * avg(e * x{i}) AS w{i}" for i in range(11)
        ) + f" FROM e{r} GROUP BY institution)")
        parts.append(f"g{r} AS (SELECT " + ", ".join(f"sum(n * w{i}) / sum(n) AS w{i}" for i in range(11)) + f" FROM l{r})")
    names = [*FEATURES, "bias"]
    return with_(*parts) + " UNION ALL ".join(
        f" SELECT CAST({r} AS BIGINT) AS round, institution, n AS num_examples, "
        + ", ".join(f"round(w{i}, 6) AS w_{c}" for i, c in enumerate(names)) + f" FROM l{r}"
        for r in range(1, rounds + 1)
    )


def network(hidden: int = 3) -> tuple[list[str], list[float]]:
    """CTEs down to `net` (inputs x, hidden sums z, outputs h, probability p of label y) and the fixed parameters."""
    n = len(FEATURES)
    count = (n + 1) * hidden + (hidden + 1) * 2
    params = [(j * 37 % 23 - 11) / 20.0 for j in range(count)]
    out = (n + 1) * hidden
    xs = ", ".join(f"coalesce({c}_s, 0.0) AS x{i}" for i, c in enumerate(FEATURES))
    zs = ", ".join(
        " + ".join(f"x{i} * ({params[i * hidden + k]})::DOUBLE" for i in range(n)) + f" + ({params[n * hidden + k]})::DOUBLE AS z{k}"
        for k in range(hidden))
    logit = " + ".join(f"h{k} * ({params[out + 2 * k + 1] - params[out + 2 * k]})::DOUBLE" for k in range(hidden))
    logit += f" + ({params[out + 2 * hidden + 1] - params[out + 2 * hidden]})::DOUBLE"
    return [
        *FEAT, POPULATION, f"ins AS (SELECT institution, hypo_risk AS y, {xs} FROM scaled)", f"sums AS (SELECT *, {zs} FROM ins)",
        "outs AS (SELECT *, " + ", ".join(f"greatest(z{k}, 0.0) AS h{k}" for k in range(hidden)) + " FROM sums)",
        f"net AS (SELECT *, 1.0 / (1.0 + exp(-({logit}))) AS p FROM outs)",
    ], params


def network_step(rate: float = 0.5, hidden: int = 3) -> str:
    """Slopes written out. The mean of the institutions' steps by examples is the step over all rows."""
    parts, params = network(hidden)
    n, out = len(FEATURES), (len(FEATURES) + 1) * hidden
    back = [f"(CASE WHEN z{k} > 0 THEN (p - y) * ({params[out + 2 * k + 1] - params[out + 2 * k]})::DOUBLE ELSE 0.0 END)" for k in range(hidden)]
    slopes = [f"x{i} * {back[k]}" for i in range(n) for k in range(hidden)] + back
    slopes += [f"h{k} * {sign}(p - y)" for k in range(hidden) for sign in ("-", "")] + ["-(p - y)", "p - y"]
    means = "means AS (SELECT " + ", ".join(f"avg({s}) AS g{j}" for j, s in enumerate(slopes)) + " FROM net)"
    return with_(*parts, means) + " UNION ALL ".join(
        f" SELECT CAST({j} AS BIGINT) AS pos, round(({params[j]})::DOUBLE - {rate}::DOUBLE * g{j}, 6) AS value FROM means" for j in range(len(params)))


def net_columns(hidden: int, params: str = "w") -> tuple[str, str, list[str]]:
    """Hidden outputs h, the probability p, and the slopes of all parameters, for inputs x, truth y and parameters `params`0, 1, ..."""
    n = len(FEATURES)
    w = lambda j: f"{params}{j}"
    out = (n + 1) * hidden
    hidden_sums = ", ".join(
        "greatest(" + " + ".join(f"x{i} * {w(i * hidden + k)}" for i in range(n)) + f" + {w(n * hidden + k)}, 0.0) AS h{k}" for k in range(hidden))
    ins, size = ([f"h{k}" for k in range(hidden)], hidden) if hidden else ([f"x{i}" for i in range(n)], n)
    logit = " + ".join(f"{ins[k]} * ({w(out + 2 * k + 1)} - {w(out + 2 * k)})" for k in range(size)) + f" + ({w(out + 2 * size + 1)} - {w(out + 2 * size)})"
    back = [f"(CASE WHEN h{k} > 0 THEN (p - y) * ({w(out + 2 * k + 1)} - {w(out + 2 * k)}) ELSE 0.0 END)" for k in range(hidden)]
    slopes = [f"x{i} * {back[k]}" for i in range(n) for k in range(hidden)] + back
    slopes += [f"{x} * {sign}(p - y)" for x in ins for sign in ("-", "")] + ["-(p - y)", "p - y"]
    return hidden_sums, f"1.0 / (1.0 + exp(-({logit})))", slopes


def descent(rounds: int, epochs: int, hidden: int, rates: list[float] | float = 0.5, weighted_classes: bool = False,
            by_institution: bool = True, name: str = "m") -> list[str]:
    """Full-batch descent unrolled. <name>_l<r>: parameters w of each client after round r; <name>_g<r>: their mean;
    <name>_t: round, institution, epoch and the training and held-out figures. The rows are in `data`."""
    hidden_sums, p, slopes = net_columns(hidden)
    count, client = len(slopes), "institution" if by_institution else "'all'"
    weight = "cw" if weighted_classes else "1.0::DOUBLE"
    start = ", ".join(f"({(j * 37 % 23 - 11) / 20.0})::DOUBLE AS w{j}" for j in range(count))
    ws = ", ".join(f"w{j}" for j in range(count))
    parts, figures = [f"{name}_g0 AS (SELECT {start})"], []

    def net(source: str, rows: str) -> str:
        h = f", {hidden_sums}" if hidden else ""
        return f"""(SELECT *, {p} AS p FROM (SELECT d.*, {ws}{h} FROM (SELECT *, {client} AS client, {weight} AS v FROM data WHERE {rows}) d
          JOIN {source} s ON s.client = d.client))"""

    cost = "-ln(greatest(CASE WHEN y = 1 THEN p ELSE 1 - p END, 1e-15))"
    for r in range(1, rounds + 1):
        rate = rates[r - 1] if isinstance(rates, list) else rates
        parts.append(f"{name}_s{r}_0 AS MATERIALIZED (SELECT client, {ws} FROM (SELECT DISTINCT {client} AS client FROM data), {name}_g{r - 1})")
        for e in range(1, epochs + 1):
            moved = ", ".join(f"min(w{j}) - {rate}::DOUBLE * sum(v * ({s})) / sum(v) AS w{j}" for j, s in enumerate(slopes))
            parts.append(f"""{name}_s{r}_{e} AS MATERIALIZED (SELECT client, count(*) AS n, sum(v * {cost}) / sum(v) AS train_loss,
              avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END) AS train_accuracy, {moved}
              FROM {net(f"{name}_s{r}_{e - 1}", "tr")} GROUP BY client)""")
            parts.append(f"""{name}_v{r}_{e} AS MATERIALIZED (SELECT client, count(*) AS n, avg({cost}) AS val_loss,
              avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END) AS val_accuracy FROM {net(f"{name}_s{r}_{e}", "NOT tr")} GROUP BY client)""")
            figures.append(f"""SELECT {r}::BIGINT AS round, s.client AS institution, {e}::BIGINT AS epoch, s.n AS num_examples, train_loss, train_accuracy,
              v.n AS val_examples, val_loss, val_accuracy FROM {name}_s{r}_{e} s JOIN {name}_v{r}_{e} v ON s.client = v.client""")
        parts.append(f"{name}_l{r} AS (SELECT * FROM {name}_s{r}_{epochs})")
        parts.append(f"{name}_g{r} AS MATERIALIZED (SELECT " + ", ".join(f"sum(n * w{j}) / sum(n) AS w{j}" for j in range(count)) + f" FROM {name}_l{r})")
    return [*parts, f"{name}_t AS ({' UNION ALL '.join(figures)})"]


# Rows of training: inputs x, truth y, whether they train, and the weight of their class in the whole institution.
TRAINING = [*FEAT, POPULATION, """drawn_rows AS (SELECT *, row_number() OVER (PARTITION BY institution ORDER BY md5('42:' || CAST(event_id AS VARCHAR)), event_id) AS rn,
  count(*) OVER (PARTITION BY institution) AS total FROM scaled)""",
    "data AS MATERIALIZED (SELECT institution, hypo_risk AS y, rn <= floor(0.8::DOUBLE * total) AS tr, total / ((SELECT count(DISTINCT hypo_risk) FROM feat f "
    "WHERE f.institution = drawn_rows.institution) * count(*) OVER (PARTITION BY institution, hypo_risk)) AS cw, "
    + ", ".join(f"coalesce({c}_s, 0.0) AS x{i}" for i, c in enumerate(FEATURES)) + " FROM drawn_rows)"]


def judged(name: str, model: str, hidden: int = 0) -> str:
    """<name>: one row of pooled figures of the parameters in `model` over the held-out rows, scores rounded to 9 digits."""
    hidden_sums, p, _ = net_columns(hidden)
    h = f", {hidden_sums}" if hidden else ""
    return f"""{name}_p AS MATERIALIZED (SELECT y AS label, round({p}, 9) AS p FROM (SELECT *{h} FROM data, {model} WHERE NOT tr)),
{name}_c AS (SELECT count(*) AS num_examples, count(*) FILTER (label = 1 AND p > 0.5) AS tp, count(*) FILTER (label = 0 AND p > 0.5) AS fp,
  count(*) FILTER (label = 1 AND p <= 0.5) AS fn, count(*) FILTER (label = 0 AND p <= 0.5) AS tn,
  avg(-ln(greatest(CASE WHEN label = 1 THEN p ELSE 1 - p END, 1e-15))) AS loss FROM {name}_p),
{name}_r AS (SELECT label, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM {name}_p),
{name}_a AS (SELECT CASE WHEN min(label) = max(label) THEN 0.0 ELSE
  (sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
    / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) END AS auc FROM {name}_r),
{name} AS (SELECT num_examples, loss, auc, {EXACT_QUALITY} FROM {name}_c, {name}_a)"""


ROLLED_OUT = """ SELECT event_id, round(glucose, 6) AS glucose, round(glucose_ma_1h, 6) AS glucose_ma_1h,
  round(glucose_std_1h, 6) AS glucose_std_1h, round(glucose_roc, 6) AS glucose_roc FROM rolled"""
STREAM_FEAT = (
    RAW, CLEAN, rolled(), TIMED, FEATURED,
    """sent AS (
  SELECT * REPLACE (coalesce(CASE WHEN steps >= 10 THEN heart_rate END, 75) AS heart_rate,
                    round(glucose, 10) AS glucose, round(glucose_ma_1h, 10) AS glucose_ma_1h,
                    coalesce(round(glucose_std_1h, 10), 0.0) AS glucose_std_1h, round(glucose_roc, 10) AS glucose_roc)
  FROM feat)""",
)

MEASURES = ("loss", "accuracy", "precision", "recall", "f1", "auc")
EXACT_QUALITY = """(tp + tn) / num_examples AS accuracy, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS "precision",
  CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1"""
EPOCH_FIGURES = ("train_loss", "train_accuracy", "val_loss", "val_accuracy")
MLP_PARAMS = (len(FEATURES) + 1) * 3 + 8
EXACT_MLP = [*TRAINING, *descent(2, 2, 3)]
HOOKED = [*TRAINING, *descent(2, 1, 3, [1.0, 0.5]), *(f"""ev{r} AS (SELECT institution, p > 0.5 AS yes, y = 1 AS truth FROM (
  SELECT *, {net_columns(3)[1]} AS p FROM (SELECT *, {net_columns(3)[0]} FROM data, m_g{r} WHERE NOT tr))),
q{r} AS (SELECT institution, avg(CASE WHEN yes = truth THEN 1.0 ELSE 0.0 END) AS accuracy,
  coalesce(2 * count(*) FILTER (yes AND truth) / nullif(2 * count(*) FILTER (yes AND truth) + count(*) FILTER (yes <> truth), 0), 0) AS f1
  FROM ev{r} GROUP BY institution)""" for r in (1, 2))]
POOLED = with_(
    *FEAT, SCORED.replace("scored AS", "per_client AS"),
    "scored AS (SELECT * FROM per_client UNION ALL SELECT 'all', * EXCLUDE institution FROM per_client)",
    CONFUSION, AUC,
    f"measured AS (SELECT institution, num_examples, loss, auc, {EXACT_QUALITY} FROM conf JOIN auc USING (institution))",
) + " UNION ALL ".join(
    f""" SELECT '{m}' AS metric,
      round(sum(num_examples * "{m}") FILTER (institution <> 'all') / sum(num_examples) FILTER (institution <> 'all'), 6)
        AS federated,
      round(max("{m}") FILTER (institution = 'all'), 6) AS centralised FROM measured""" for m in MEASURES
)

EVENT_FEAT = with_(RAW, """feat AS (
  SELECT *, coalesce(raw_glucose, 120.0) AS glucose, CASE WHEN raw_glucose < 70 THEN 1 ELSE 0 END AS hypo_risk FROM raw)""")

ORACLE_SQL = {
    "csv_jsonl_roundtrip": with_(RAW) + """ SELECT institution, series_id, event_id,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(raw_glucose, 6) AS glucose, steps, heart_rate FROM raw""",
    "ml_table_roundtrip": ML,
    "ml_input_dimension": with_(RAW) + f" SELECT institution, CAST({len(FEATURES)} AS BIGINT) AS input_dim FROM raw GROUP BY institution",
    "glucose_median": with_(RAW) + " SELECT count(raw_glucose) AS known, median(raw_glucose) AS median_glucose FROM raw",
    "clean_median_clip": with_(RAW, CLEAN) + " SELECT event_id, round(glucose, 6) AS glucose FROM clean",
    "time_features": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CAST(hour(ts) AS INTEGER) AS hour,
      CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CASE WHEN hour(ts) >= 22 OR hour(ts) <= 6 THEN 1 ELSE 0 END AS is_night,
      CASE WHEN isodow(ts) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend FROM events""",
    "regular_times": """SELECT event_id, strftime(TIMESTAMP '2024-01-01 00:00:00'
      + to_minutes(5 * (row_number() OVER (ORDER BY event_id) - 1)), '%Y-%m-%d %H:%M:%S') AS ts FROM events""",
    "glucose_aliases": with_(RAW) + """ SELECT event_id, found_as, round(raw_glucose, 6) AS glucose
      FROM raw, (VALUES ('glucose'), ('bg'), ('blood_glucose'), ('glucose_value'), ('CGM')) AS names(found_as)""",
    "category_stream": with_(RAW) + """ SELECT event_id, CASE WHEN raw_glucose < 70 THEN 'low'
      WHEN raw_glucose > 180 THEN 'high' ELSE 'normal' END AS glucose_category FROM raw""",
    "category_batch": with_(RAW) + """ SELECT event_id, CASE WHEN raw_glucose <= 0 OR raw_glucose > 500 THEN NULL
      WHEN raw_glucose <= 70 THEN 'low' WHEN raw_glucose <= 180 THEN 'normal' WHEN raw_glucose > 180 THEN 'high' END
      AS glucose_category FROM raw""",
    "hypo_labels": with_(RAW) + """ SELECT event_id,
      CASE WHEN raw_glucose < 70 THEN 1 ELSE 0 END AS hypo_risk FROM raw""",
    "constant_fill": with_(RAW, rolled("raw", glucose="raw_glucose")) + """ SELECT event_id,
      round(coalesce(raw_glucose, 120), 6) AS glucose, round(coalesce(glucose_ma_1h, 120), 6) AS glucose_ma_1h,
      round(coalesce(glucose_std_1h, 0), 6) AS glucose_std_1h, round(coalesce(glucose_roc, 0), 6) AS glucose_roc,
      CASE WHEN event_type = 'view' THEN 0 ELSE coalesce(steps, 0) END AS steps, coalesce(heart_rate, 75) AS heart_rate,
      CAST(hour(ts) AS INTEGER) AS hour FROM rolled""",
    "processed_table": with_(RAW, CLEAN, rolled(), TIMED, FEATURED) + """ SELECT institution, series_id, event_id,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp", round(glucose, 6) AS glucose,
      round(glucose_ma_1h, 6) AS glucose_ma_1h, round(glucose_std_1h, 6) AS glucose_std_1h,
      round(glucose_roc, 6) AS glucose_roc, steps, heart_rate, hour, day_of_week, hypo_risk FROM feat""",
    "rolling_by_series": with_(RAW, CLEAN, rolled()) + ROLLED_OUT,
    "rolling_short_series": with_(RAW, CLEAN, rolled(series="series_id, event_type")) + ROLLED_OUT,
    "rolling_long_series": with_(RAW, CLEAN, rolled()) + ROLLED_OUT,
    "rolling_whole_table": with_(RAW, CLEAN, rolled(series="")) + ROLLED_OUT,
    "stats_global": with_(*FEAT) + stats(" SELECT"),
    "stats_by_institution": with_(*FEAT) + stats(" SELECT institution,", "GROUP BY institution"),
    "record_count_by_institution": with_(RAW) + " SELECT institution, count(*) AS records FROM raw GROUP BY institution",
    "class_counts": with_(*FEAT) + """ SELECT institution, hypo_risk, count(*) AS records FROM feat
      GROUP BY institution, hypo_risk""",
    "class_weight_table": with_(*FEAT) + """ SELECT institution, hypo_risk, records,
      round(sum(records) OVER i / (count(*) OVER i * records), 6) AS weight
      FROM (SELECT institution, hypo_risk, count(*) AS records FROM feat GROUP BY institution, hypo_risk)
      WINDOW i AS (PARTITION BY institution)""",
    "class_weighted_rows": with_(*FEAT) + """ SELECT event_id, institution, hypo_risk,
      round(count(*) OVER (PARTITION BY institution) / (
        (SELECT count(DISTINCT hypo_risk) FROM feat x WHERE x.institution = feat.institution)
        * count(*) OVER (PARTITION BY institution, hypo_risk)), 6) AS weight FROM feat""",
    "rejected_rows": with_(RAW, CLEAN, rolled()) + """ SELECT institution,
      count(*) FILTER (glucose_std_1h IS NULL) AS rejected FROM rolled GROUP BY institution""",
    "network_scores": with_(*network()[0]) + """ SELECT institution, y AS label, count(*) AS records, round(avg(p), 6) AS mean_p,
      round(min(p), 6) AS least_p, round(max(p), 6) AS greatest_p FROM net GROUP BY institution, y""",
    "network_step": network_step(),
    "synth_vitals": f"""SELECT event_id, CAST(({drawn('steps:42')}) % 100 AS INTEGER) AS steps,
      CAST(({drawn('heart:42')}) % 60 + 60 AS INTEGER) AS heart_rate FROM events""",
    "shuffled_rows": with_(ranked("events")) + " SELECT event_id, rn - 1 AS position FROM ranked",
    "institution_split": with_(ranked("events")) + """ SELECT event_id, 'institution_' || (1 + CASE WHEN total // 3 = 0
      THEN 2 ELSE least((rn - 1) // greatest(total // 3, 1), 2) END) AS institution FROM ranked""",
    "train_val_split": with_(RAW, ranked("raw", "PARTITION BY institution")) + """ SELECT institution, event_id,
      CASE WHEN rn <= floor(0.8::DOUBLE * total) THEN 1 ELSE 0 END AS is_train FROM ranked""",
    "scaled_population": ML,
    "scaled_sample": with_(*FEAT, scaled("stddev_samp", "PARTITION BY institution"))
    + f" SELECT institution, event_id, {SPREAD}, hypo_risk FROM scaled",
    "scaled_stages": with_(*FEAT, scaled("stddev_samp", "")) + f" SELECT event_id, {SPREAD}, hypo_risk FROM scaled",
    "scaled_on_train": with_(*FEAT, ranked("feat", "PARTITION BY institution"), """stat AS (
      SELECT institution, """ + ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_d" for c in FEATURES)
        + " FROM ranked WHERE rn <= floor(0.8::DOUBLE * total) GROUP BY institution)")
    + " SELECT event_id, " + ", ".join(f"round(coalesce(({c} - {c}_m) / nullif({c}_d, 0), 0.0), 6) AS {c}" for c in FEATURES)
    + " FROM feat JOIN stat USING (institution)",
    "union_of_institutions": with_(*FEAT, POPULATION) + f" SELECT event_id, {SPREAD}, hypo_risk FROM scaled",
    "confusion_by_institution": with_(*FEAT, SCORED, CONFUSION)
    + f" SELECT institution, num_examples, tp, fp, fn, tn, {QUALITY} FROM conf",
    "roc_auc_by_institution": with_(*FEAT, SCORED, AUC) + " SELECT institution, round(auc, 6) AS auc FROM auc",
    "roc_auc_in_ranges": with_(*FEAT, """scored AS (
      SELECT institution, hypo_risk AS label, -round(glucose_ma_1h, 6) AS s FROM feat)""", AUC)
    + " SELECT institution, round(auc, 6) AS auc FROM auc",
    "cross_entropy_by_institution": with_(*FEAT, SCORED, CONFUSION) + " SELECT institution, round(loss, 6) AS loss FROM conf",
    "evaluation_by_institution": with_(*FEAT, SCORED, CONFUSION, AUC)
    + f" SELECT institution, num_examples, round(loss, 6) AS loss, round(auc, 6) AS auc, {QUALITY} FROM conf JOIN auc USING (institution)",
    "weighted_client_metrics": with_(*FEAT, CLIENTS, weighted("w", "clients", FIT))
    + " SELECT CAST(round AS BIGINT) AS round, num_examples, " + ", ".join(f"round({m}, 6) AS {m}" for m in FIT) + " FROM w",
    "round_history": HISTORY_WIDE,
    "round_history_wide": HISTORY_WIDE,
    "round_history_long": with_(*FEAT, CLIENTS, *HISTORY) + " UNION ALL ".join(
        f" SELECT CAST(round AS BIGINT) AS round, '{c}' AS metric, round({c}, 6) AS value FROM hist WHERE {c} IS NOT NULL"
        for c in HISTORY_COLUMNS),
    "best_round": with_(*FEAT, CLIENTS, *HISTORY) + """ SELECT count(*) AS total_rounds,
      round(arg_max(val_accuracy, round), 6) AS final_val_accuracy, round(arg_max(val_f1, round), 6) AS final_val_f1,
      round(arg_max(val_auc, round), 6) AS final_val_auc,
      (SELECT CAST(round AS BIGINT) FROM hist ORDER BY val_accuracy DESC NULLS LAST, round LIMIT 1) AS best_round,
      round(max(val_accuracy), 6) AS best_val_accuracy FROM hist""",
    "last_epoch_metrics": with_(*FEAT, """epochs AS (
      SELECT day(ts) AS round, institution, hour, avg(glucose) AS tl, avg(hypo_risk) AS ta FROM feat GROUP BY ALL)""")
    + """ SELECT CAST(round AS BIGINT) AS round, institution, round(arg_max(tl, hour), 6) AS train_loss,
      round(arg_max(ta, hour), 6) AS train_accuracy FROM epochs GROUP BY round, institution""",
    "history_export": with_(*FEAT, CLIENTS, *HISTORY) + """ SELECT string_agg(CAST(round AS VARCHAR), ',' ORDER BY round)
      AS rounds, count(train_accuracy) AS train_rounds, round(sum(val_accuracy), 6) AS val_accuracy_sum FROM hist""",
    "pooled_against_clients": POOLED,
    "client_sample": """WITH users AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS institution FROM events),
      drawn AS (SELECT institution, CAST(r AS BIGINT) AS round, count(*) OVER (PARTITION BY r) AS k, row_number() OVER (
          PARTITION BY r ORDER BY md5('42:' || CAST(r AS VARCHAR) || ':' || institution), institution) AS n
        FROM users, range(1, 4) t(r))
      SELECT institution, round FROM drawn WHERE n <= greatest(CAST(floor(0.1::DOUBLE * k) AS BIGINT), 2)""",
    "first_reading": with_(RAW) + """ SELECT series_id, event_id, raw_glucose AS glucose, steps FROM raw
      QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY ts, event_id) = 1""",
    "fedavg_weighted": averaged("sum(n * {p}) / sum(n)"),
    "fedavg_unweighted": averaged("avg({p})"),
    "fedavg_embeddings": """WITH v AS (SELECT label, vec_id % 7 + 1 AS n, unnest(embedding)::DOUBLE AS x,
      generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)
      SELECT CAST(label AS BIGINT) AS label, CAST(pos AS BIGINT) AS pos, round(sum(n * x) / sum(n), 6) AS value
      FROM v GROUP BY label, pos""",
    "fed_logreg_rounds": logistic_rounds(),
    "fed_mlp_exact": with_(*EXACT_MLP) + " UNION ALL ".join(
        f""" SELECT {r}::BIGINT AS round, client AS institution, n AS num_examples, j::BIGINT AS pos, round(value, 6) AS value
        FROM (SELECT client, n, unnest(list_value({", ".join(f"w{j}" for j in range(MLP_PARAMS))})) AS value, unnest(range({MLP_PARAMS})) AS j FROM m_l{r})"""
        for r in (1, 2)),
    "training_epochs": with_(*EXACT_MLP) + " SELECT round, institution, epoch, num_examples, val_examples, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in EPOCH_FIGURES) + " FROM m_t",
    "last_epoch_of_training": with_(*EXACT_MLP) + " SELECT round, institution, " + ", ".join(f"round({c}, 6) AS {c}" for c in EPOCH_FIGURES)
    + " FROM m_t WHERE epoch = 2",
    "central_logistic": with_(*TRAINING, *descent(1, 4, 0, weighted_classes=True, by_institution=False), judged("j", "m_g1"))
    + " SELECT num_examples, " + ", ".join(f'round("{m}", 6) AS "{m}"' for m in MEASURES) + " FROM j",
    "compare_models": with_(*TRAINING, *descent(2, 2, 0), *descent(1, 4, 0, by_institution=False, name="c"), judged("f", "m_g2"), judged("a", "c_g1"))
    + " UNION ALL ".join(f""" SELECT '{m}' AS metric, round(f."{m}", 6) AS federated, round(a."{m}", 6) AS centralised FROM f, a""" for m in MEASURES),
    "hooked_rounds": with_(*HOOKED) + " UNION ALL ".join(f""" SELECT {r}::BIGINT AS round, (SELECT round(max(train_loss), 6) FROM m_t WHERE round = {r}) AS train_loss,
      (SELECT round(min(train_accuracy), 6) FROM m_t WHERE round = {r}) AS train_accuracy, (SELECT round(min(val_loss), 6) FROM m_t WHERE round = {r}) AS val_loss,
      round(min(accuracy), 6) AS val_accuracy, round(max(f1), 6) AS val_f1 FROM q{r}""" for r in (1, 2)),
    "stream_enrich": with_(*STREAM_FEAT) + """ SELECT institution, series_id, event_id,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(glucose, 6) AS glucose, round(glucose_ma_1h, 6) AS glucose_ma_1h,
      round(glucose_std_1h, 6) AS glucose_std_1h, round(glucose_roc, 6) AS glucose_roc, steps, heart_rate, hour,
      day_of_week, hypo_risk, is_night, is_weekend, CASE WHEN glucose < 70 THEN 'low' WHEN glucose > 180 THEN 'high'
      ELSE 'normal' END AS glucose_category FROM sent""",
    "stream_fan_out": with_(*FEAT) + """ SELECT institution, count(*) AS records,
      count(*) FILTER (hypo_risk = 1) AS risky FROM feat GROUP BY institution""",
    "stream_memory": with_(*STREAM_FEAT) + stats(" SELECT institution,", "GROUP BY institution").replace("FROM feat", "FROM sent"),
    "stream_stats": EVENT_FEAT + stats(" SELECT institution,", "GROUP BY institution"),
    "stream_series_stats": EVENT_FEAT + stats(" SELECT institution, series_id,", "GROUP BY institution, series_id").replace(", 6)", ", 9)"),
    "stream_to_ml": with_(*STREAM_FEAT, scaled("stddev_samp", "").replace("FROM feat", "FROM sent"))
    + f" SELECT event_id, {SPREAD}, hypo_risk FROM scaled",
}
ORACLE_SQL |= {"stream_restart": ORACLE_SQL["stream_enrich"], "stream_restart_stats": ORACLE_SQL["stream_stats"]}
