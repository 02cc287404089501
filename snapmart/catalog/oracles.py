"""The registered queries as DuckDB SQL over the given tables."""

from snapmart.catalog.fixtures import VIEWS, duck_view

TRAIN = ("1996-02-01", "1997-04-01")
OOT = ("1997-05-01", "1997-09-01")

IN_TRAIN = f"snapdate BETWEEN DATE '{TRAIN[0]}' AND DATE '{TRAIN[1]}'"
IN_OOT = f"snapdate BETWEEN DATE '{OOT[0]}' AND DATE '{OOT[1]}'"
LABELLED = "lower(Churn) IN ('yes', 'no')"

TOKENS = "('unknown','unk','na','n/a','null','none','nan','-','')"


def norm(c):
    return (f"regexp_replace(replace(replace(lower(trim(coalesce(CAST({c} AS VARCHAR),'nan'))),'—','-'),'–','-'),"
            f"'\\s*/\\s*','/','g')")


def complete(*cols):
    return " AND ".join(f"{norm(c)} NOT IN {TOKENS}" for c in cols)


def num(c):
    s = f"lower(trim({c}))"
    return (f"CASE WHEN regexp_full_match({s}, '[+-]?((\\d+\\.?\\d*|\\.\\d+)(e[+-]?\\d+)?|inf|infinity)') "
            f"THEN CAST({s} AS DOUBLE) END")


def share(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0)"


# --- fixed values: what each raw value of the demographic view is cleaned to ----------------
CANON = {
    "gender": {" MALE": "male", "Female ": "female", "f": "female", "femail": "female", "female": "female",
               "femalee": "female", "fmale": "female", "maie": "male", "mal": "male", "male": "male"},
    "Partner": {"0": "No", "1.0": "Yes", "N": "No", "No.": "No", "Yep": "Yes", "es": "Yes", "yes": "Yes", "是": "Yes"},
    "Dependents": {"TRUE": "Yes", "false": "No", "nope": "No", "off": "No", "on": "Yes", "y": "Yes", "无": "No"},
    "EducationLevel": {"College": "College", "High School": "HighSchool", "bachelor": "Bachelor",
                       "bachelur": "Bachelor", "colege": "College", "collage": "College", "highschol": "HighSchool"},
    "EmploymentStatus": {"Retired": "Retired", "Self-Employed": "Self-employed", "employed": "Employed",
                         "retird": "Retired", "self employed": "Self-employed", "unemployed": "Employed"},
    "AnnualIncomeBracket": {"100—150k": "100–150k", "1t0-150k": "100–150k", "60–100k": "60–100k",
                            "6z-100k": "60–100k", ">150k": ">150k", ">15mk": ">150k"},
}
# --- fixed values: (column, raw value of the view, text scored, best choice, score) ---------
SCORED = [
    ("gender", "femalee", "femalee", "female", 92.3077), ("gender", "fmale", "fmale", "female", 90.9091),
    ("gender", "mal", "mal", "male", 85.7143), ("gender", "unknown", "unknown", "female", 0.0),
    ("gender", None, "nan", "male", 28.5714),
    ("Partner", "es", "es", "Yes", 80.0), ("Partner", "yes!", "yes!", "Yes", 57.1429),
    ("EducationLevel", "colege", "colege", "College", 76.9231),
    ("EducationLevel", "bachelur", "bachelur", "Bachelor", 75.0),
    ("EducationLevel", "phd", "phd", "Bachelor", 18.1818),
    ("EducationLevel", "highschol", "highschol", "HighSchool", 73.6842),
    ("EmploymentStatus", "retird", "retird", "Retired", 76.9231),
    ("EmploymentStatus", "self employed", "self employed", "Self-employed", 84.6154),
    ("EmploymentStatus", "unemployed", "unemployed", "Employed", 77.7778),
    ("EmploymentStatus", "student", "student", "Retired", 28.5714),
    ("AnnualIncomeBracket", "1t0-150k", "150-150k", "100-150k", 87.5),
    ("AnnualIncomeBracket", "n / a", "n / a", "60-100k", 0.0),
]
DEMO = list(CANON)


def lit(v):
    return "CAST(NULL AS VARCHAR)" if v is None else "'" + v.replace("'", "''") + "'"


def canon_case(c):
    return f"CASE {c} " + " ".join(f"WHEN {lit(a)} THEN {lit(b)}" for a, b in CANON[c].items()) + " END"


FENCE_COLS = ("MonthlyCharges", "AverageDataUsage", "AppLoginFrequency")
GOLD_FEATURES = ["Contract", "PaymentMethod", "InternetService", "StreamingTV", *DEMO, *FENCE_COLS,
                 "CustomerSatisfactionScore"]


def fold(key):
    """Fold of a row by its key, as the target encoding deals rows."""
    return f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 5)"


def last_per(table, keys, cols, where="TRUE"):
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ord_ DESC) AS rn "
            f"FROM {table} WHERE {where}) z WHERE rn = 1")


# name -> (dependencies, select)
PARTS = {name: ((), duck_view(name)) for name in VIEWS}
PARTS |= {
    "labels": (("fx_label",), """
        SELECT customerID, TRY_CAST(snapdate AS DATE) AS snapdate, Churn, ord_ FROM fx_label
        WHERE TRY_CAST(snapdate AS DATE) IS NOT NULL"""),
    "dated": (("fx_order_dates", "fx_ship_dates"), """
        SELECT "table", ord_, coalesce(CAST(try_strptime(snapdate, '%Y-%m-%d') AS DATE), CAST(try_strptime(snapdate, '%Y/%m/%d') AS DATE),
                                       CAST(try_strptime(snapdate, '%Y%m%d') AS DATE)) AS date,
               CASE WHEN try_strptime(snapdate, '%Y-%m-%d') IS NOT NULL THEN 'yyyy-MM-dd'
                    WHEN try_strptime(snapdate, '%Y/%m/%d') IS NOT NULL THEN 'yyyy/MM/dd'
                    WHEN try_strptime(snapdate, '%Y%m%d') IS NOT NULL THEN 'yyyyMMdd' END AS format
        FROM (SELECT 'orders' AS "table", * FROM fx_order_dates UNION ALL SELECT 'lineitem', * FROM fx_ship_dates) t"""),
    "staged": (("fx_rounds",), "SELECT model, round, y, margin AS p FROM fx_rounds"),
    "order_churn": (("fx_label",), f"""
        SELECT customerID AS value, CASE lower(Churn) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS y, {fold('ord_')} AS fold
        FROM fx_label WHERE lower(Churn) IN ('yes', 'no')"""),
    "coded": (("labels",), """
        SELECT trim(customerID) AS customerID, snapdate, ord_,
               CASE lower(Churn) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS y FROM labels"""),
    "nums": (("fx_financial",), f"""
        SELECT customerID, MonthlyCharges AS mc_raw, AverageDataUsage AS du_raw, AppLoginFrequency AS al_raw,
               CustomerSatisfactionScore, ord_,
               {num('MonthlyCharges')} AS mc, {num('AverageDataUsage')} AS du, {num('AppLoginFrequency')} AS al
        FROM fx_financial"""),
    "base": (("nums",), """
        SELECT *, CASE WHEN mc < 0 THEN 0.0 ELSE mc END AS mc0, CASE WHEN du >= 0 THEN du END AS du0,
               floor(CASE WHEN al < 0 THEN 0.0 ELSE al END) AS al0 FROM nums"""),
    "fences": (("base",), """
        SELECT 'MonthlyCharges' AS "column", quantile_cont(mc0, 0.25) AS q1, quantile_cont(mc0, 0.75) AS q3 FROM base
        UNION ALL SELECT 'AverageDataUsage', quantile_cont(du0, 0.25), quantile_cont(du0, 0.75) FROM base
        UNION ALL SELECT 'AppLoginFrequency', quantile_cont(al0, 0.25), quantile_cont(al0, 0.75) FROM base"""),
    "uppers": (("fences",), """
        SELECT max(CASE WHEN "column" = 'MonthlyCharges' THEN q3 + 3.0 * greatest(q3 - q1, 0.0) END) AS mcu,
               max(CASE WHEN "column" = 'AverageDataUsage' THEN q3 + 3.0 * greatest(q3 - q1, 0.0) END) AS duu,
               max(CASE WHEN "column" = 'AppLoginFrequency' THEN q3 + 3.0 * greatest(q3 - q1, 0.0) END) AS alu
        FROM fences"""),
    "financial": (("base", "uppers"), """
        SELECT customerID, ord_, CustomerSatisfactionScore,
               round_even(CASE WHEN mc0 > mcu THEN mcu ELSE mc0 END * 100, 0) / 100 AS MonthlyCharges,
               round_even(CASE WHEN du0 <= duu THEN du0 END * 100, 0) / 100 AS AverageDataUsage,
               CAST(CASE WHEN al0 <= alu THEN al0 END AS BIGINT) AS AppLoginFrequency,
               mc_raw, du_raw, al_raw, coalesce(mc < 0, FALSE) AS mc_neg, coalesce(du < 0, FALSE) AS du_neg,
               coalesce(al < 0, FALSE) AS al_neg, coalesce(al >= 0 AND al <> floor(al), FALSE) AS al_frac,
               coalesce(mc0 > mcu, FALSE) AS mc_out, coalesce(du0 > duu, FALSE) AS du_out,
               coalesce(al0 > alu, FALSE) AS al_out
        FROM base, uppers"""),
    "demographic": (("fx_demographic",),
                    "SELECT customerID, " + ", ".join(f"{canon_case(c)} AS {c}" for c in DEMO)
                    + ", ord_ FROM fx_demographic"),
    "contract": (("fx_contract",), """
        SELECT customerID, Contract, PaymentMethod, min(ord_) AS ord_ FROM fx_contract
        WHERE lower(coalesce(Contract, 'nan')) <> 'unknown' GROUP BY customerID, Contract, PaymentMethod"""),
    "service": (("fx_service",), """
        SELECT customerID, coalesce(InternetService, '') AS InternetService,
               coalesce(StreamingTV, '') AS StreamingTV, min(ord_) AS ord_ FROM fx_service GROUP BY 1, 2, 3"""),
    "contract1": (("contract",), last_per("contract", "customerID", "customerID, Contract, PaymentMethod",
                                          complete("Contract", "PaymentMethod"))),
    "service1": (("service",), last_per("service", "customerID", "customerID, InternetService, StreamingTV",
                                        complete("InternetService", "StreamingTV"))),
    "demographic1": (("demographic",), last_per("demographic", "customerID", "customerID, " + ", ".join(DEMO),
                                                complete(*DEMO))),
    "financial1": (("financial",), last_per(
        "financial", "customerID", "customerID, " + ", ".join(FENCE_COLS) + ", CustomerSatisfactionScore",
        complete(*FENCE_COLS, "CustomerSatisfactionScore"))),
    "labels1": (("labels",), last_per(
        "(SELECT trim(customerID) AS customerID, snapdate, Churn, ord_ FROM labels)", "customerID, snapdate",
        "customerID, snapdate, Churn", complete("customerID", "Churn"))),
    "gold": (("labels1", "contract1", "service1", "demographic1", "financial1"),
             "SELECT customerID, snapdate, Churn, " + ", ".join(GOLD_FEATURES) + """
        FROM labels1 JOIN contract1 USING (customerID) JOIN service1 USING (customerID)
        JOIN demographic1 USING (customerID) JOIN financial1 USING (customerID)"""),
    "training": (("coded",), last_per(
        "coded", "customerID, snapdate", "customerID, snapdate, y AS Churn, ord_",
        f"y IS NOT NULL AND snapdate BETWEEN DATE '{TRAIN[0]}' AND DATE '{TRAIN[1]}'")),
    "months": (("labels",), """
        SELECT m, row_number() OVER (ORDER BY m) AS i, count(*) OVER () AS n
        FROM (SELECT DISTINCT date_trunc('month', snapdate) AS m FROM labels) d"""),
    "month_split": (("months",), """
        SELECT m, CASE WHEN i > n - k THEN 'monitor' WHEN i <= floor((n - k) * 0.75) THEN 'train' ELSE 'test' END AS split
        FROM (SELECT *, CASE WHEN n >= 5 THEN 5 ELSE greatest(1, n // 3) END AS k FROM months) q"""),
    "calendar": (("labels",), """
        SELECT CAST(unnest(generate_series(CAST(min(snapdate) AS TIMESTAMP) - INTERVAL 2 MONTH,
               CAST(max(snapdate) AS TIMESTAMP) + INTERVAL 4 MONTH, INTERVAL 1 MONTH)) AS DATE) AS month FROM labels"""),
    "marked": (("fx_scores",), """
        SELECT *, CASE WHEN month <= '1998-12' THEN 'validation' ELSE 'oot' END AS dataset FROM fx_scores"""),
    "train_matrix": (("training", "financial", "demographic"), """
        SELECT t.customerID, t.snapdate, t.Churn, MonthlyCharges, AverageDataUsage, AppLoginFrequency, gender,
               EducationLevel FROM training t
        JOIN (SELECT customerID, gender, EducationLevel FROM (SELECT *, row_number() OVER (
              PARTITION BY customerID ORDER BY ord_ DESC) AS rn FROM demographic) WHERE rn = 1) d USING (customerID)
        JOIN financial f USING (customerID)"""),
}

# tie-free ranking metrics of a scores relation, per grouping columns
RANK_SQL = """
ranked AS (SELECT {g}, p, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS neg
           FROM {t} GROUP BY {g}, p),
summed AS (SELECT *, sum(pos) OVER w - pos AS pb, sum(neg) OVER w - neg AS nb, sum(pos) OVER (PARTITION BY {g}) AS pt,
           sum(neg) OVER (PARTITION BY {g}) AS nt FROM ranked
           WINDOW w AS (PARTITION BY {g} ORDER BY p ROWS UNBOUNDED PRECEDING)),
rank_metrics AS (SELECT {g},
           CASE WHEN max(pt) > 0 AND max(nt) > 0 THEN
             sum(CAST(pos AS DOUBLE) * (nb + neg / 2.0)) / (CAST(max(pt) AS DOUBLE) * max(nt)) END AS auc,
           CASE WHEN max(pt) > 0 AND max(nt) > 0 THEN
             sum(CAST(pos AS DOUBLE) / pt * (pt - pb) / ((pt - pb) + (nt - nb))) END AS average_precision,
           CASE WHEN max(pt) > 0 AND max(nt) > 0 THEN
             max(abs(CAST(pb + pos AS DOUBLE) / greatest(1, pt) - CAST(nb + neg AS DOUBLE) / greatest(1, nt))) END AS ks
           FROM summed GROUP BY {g})"""

CELLS = """count(*) FILTER (WHERE y = 0 AND p < 0.5) AS tn, count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp,
           count(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn, count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp"""
ACC, PREC = share("tp + tn", "tp + tn + fp + fn"), share("tp", "tp + fp")
REC, F1 = share("tp", "tp + fn"), share("2 * tp", "2 * tp + fp + fn")
CALIBRATION = """avg((y - p) * (y - p)) AS brier,
           -avg(CASE WHEN y = 1 THEN ln(least(greatest(p, 1e-7), 1 - 1e-7))
                     ELSE ln(1 - least(greatest(p, 1e-7), 1 - 1e-7)) END) AS logloss,
           avg(p) AS pred_mean, stddev_pop(p) AS pred_std, count(*) FILTER (WHERE y = 1) AS positives,
           count(*) FILTER (WHERE y = 0) AS negatives, count(*) AS n"""
EDGES = [0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9]
BIN = ("CASE WHEN p BETWEEN 0.0 AND 1.0 THEN "
       + " + ".join(f"CASE WHEN p >= CAST('{e!r}' AS DOUBLE) THEN 1 ELSE 0 END" for e in EDGES) + " END")


def rounded(*cols):
    return ", ".join(f"round({c} + 1e-12, 9) AS {c}" for c in cols)


def psi_sql(source, side, groups):
    """PSI of the rows of ``source`` on side 'expected' against 'actual'."""
    g = "".join(f"{c}, " for c in groups)
    by = "GROUP BY " + ", ".join(groups) if groups else ""
    on = " AND ".join([f"c.{c} = b.{c}" for c in groups]) or "TRUE"
    keys = f"(SELECT DISTINCT {', '.join(groups)} FROM sided)" if groups else "(SELECT 1 AS one)"
    share_ = ("CASE WHEN coalesce(sum({n}), 0) = 0 THEN 0.0001 ELSE CAST(sum({n}) AS DOUBLE) / max({t}) END")
    return f"""
sided AS (SELECT {g}{side} AS side, {BIN} AS bin FROM {source}),
sizes AS (SELECT {g}count(*) FILTER (WHERE side = 'expected') AS te, count(*) FILTER (WHERE side = 'actual') AS ta
          FROM sided {by}),
binned AS (SELECT {g}bin, count(*) FILTER (WHERE side = 'expected') AS ne, count(*) FILTER (WHERE side = 'actual') AS na
           FROM sided GROUP BY {g}bin),
cells AS (SELECT * FROM {keys} k, (SELECT unnest(range(10)) AS bin) r),
parts AS (SELECT {''.join(f'c.{c}, ' for c in groups)}c.bin,
          {share_.format(n='b.ne', t='s.te')} AS e, {share_.format(n='b.na', t='s.ta')} AS a
          FROM cells c LEFT JOIN binned b ON {on} AND c.bin = b.bin
          JOIN sizes s ON {' AND '.join(f'c.{c} = s.{c}' for c in groups) or 'TRUE'}
          GROUP BY {''.join(f'c.{c}, ' for c in groups)}c.bin),
index AS (SELECT {g}sum((a - e) * ln(a / e)) AS psi FROM parts {by})"""


def closure(names):
    """Dependencies first."""
    out = []

    def visit(n):
        for d in PARTS[n][0]:
            visit(d)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


def sql(select, *parts, extra=""):
    ctes = [f"{n} AS ({PARTS[n][1]})" for n in closure(parts)]
    if extra:
        ctes.append(extra.strip())
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + select


def ranking(select, groups, table, *parts):
    return sql(select, *parts, extra=RANK_SQL.format(g=groups, t=table))


FULL_FLAGS = {
    "clean_monthly_charges": ("MonthlyCharges, mc_raw AS MonthlyCharges_raw, mc_neg AS MonthlyCharges_was_negative, "
                              "mc_out AS MonthlyCharges_was_outlier"),
    "clean_data_usage": ("AverageDataUsage, du_raw AS AverageDataUsage_raw, du_neg AS AverageDataUsage_was_negative, "
                         "du_out AS AverageDataUsage_was_outlier_high"),
    "clean_app_logins": ("AppLoginFrequency, al_raw AS AppLoginFrequency_raw, al_neg AS AppLoginFrequency_was_negative, "
                         "al_frac AS AppLoginFrequency_was_fractional, al_out AS AppLoginFrequency_was_outlier_high"),
}
SPLIT_PART = """
hashed AS (SELECT doc_id, quality, md5(CAST(doc_id AS VARCHAR) || ':42') AS h FROM documents JOIN labels USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY h) AS rn, count(*) OVER (PARTITION BY quality) AS n
           FROM hashed)"""
MODE_PART = "mode_of AS (" + " UNION ALL ".join(
    f"(SELECT '{c}' AS col, {c} AS v FROM demographic WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    for c in DEMO) + ")"
REPORT_PART = f"""
cm AS (SELECT model, {CELLS} FROM fx_scores GROUP BY model),
pc AS (SELECT model, tn, fp, fn, tp, tn + fp AS s0, fn + tp AS s1, tn + fp + fn + tp AS n,
       {share('tn', 'tn + fn')} AS p0, {share('tn', 'tn + fp')} AS r0, {share('2 * tn', '2 * tn + fn + fp')} AS f0,
       {share('tp', 'tp + fp')} AS p1, {share('tp', 'tp + fn')} AS r1, {share('2 * tp', '2 * tp + fp + fn')} AS f1,
       {ACC} AS acc FROM cm),
lines AS (SELECT model, '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM pc
  UNION ALL SELECT model, '1', p1, r1, f1, s1 FROM pc
  UNION ALL SELECT model, 'accuracy', acc, acc, acc, n FROM pc
  UNION ALL SELECT model, 'macro avg', (p0 + p1) / 2.0, (r0 + r1) / 2.0, (f0 + f1) / 2.0, n FROM pc
  UNION ALL SELECT model, 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n
  FROM pc)"""
EVAL_PART = f"cm AS (SELECT model, dataset, {CELLS} FROM marked GROUP BY model, dataset)"
MARK_SIDE = "CASE WHEN month <= '1998-12' THEN 'expected' ELSE 'actual' END"
CASE_METRICS = [("Accuracy", "accuracy"), ("AUC-ROC", "auc"), ("Precision", "precision"), ("Recall", "recall")]
RANGE_CASE = (f"CASE WHEN snapdate BETWEEN DATE '{TRAIN[0]}' AND DATE '{TRAIN[1]}' THEN 'train' "
              f"WHEN snapdate BETWEEN DATE '{OOT[0]}' AND DATE '{OOT[1]}' THEN 'oot' END")


def oracle_sql():
    out = {
        "gold_snapshot": sql("SELECT * FROM gold", "gold"),
        "parse_snapdate": sql("SELECT * FROM labels", "labels"),
        "bad_date_count": sql("SELECT count(*) AS n_rows, count(*) FILTER (WHERE TRY_CAST(snapdate AS DATE) IS NULL) "
                              "AS n_bad FROM fx_label", "fx_label"),
        "date_format_votes": sql("""
            SELECT "table", format, count(*) AS n, min(ord_) AS first FROM dated WHERE format IS NOT NULL GROUP BY "table", format""", "dated"),
        "dates_in_two_formats": sql("""
            SELECT d."table", CASE WHEN d.format = e.format THEN d.date END AS snapdate, count(*) AS n
            FROM dated d LEFT JOIN (SELECT "table", min_by(format, ord_) AS format FROM dated WHERE format IS NOT NULL GROUP BY "table") e
              ON d."table" = e."table" GROUP BY ALL""", "dated"),
        "bronze_partition_counts": sql("SELECT snapdate, count(*) AS n FROM labels GROUP BY snapdate", "labels"),
        "snapshot_from_filename": sql("""
            SELECT DISTINCT file_name, CAST(try_strptime(nullif(regexp_extract(file_name, '(\\d{4}_\\d{2}_\\d{2})', 1), ''),
                   '%Y_%m_%d') AS DATE) AS snapdate
            FROM (SELECT 'gold_' || replace(CASE WHEN ord_ % 50 = 0 THEN substr(snapdate, 1, 4) || '-13-01'
                  ELSE snapdate END, '-', '_') || '.csv' AS file_name FROM fx_label) q""", "fx_label"),
        "month_calendar": sql("SELECT month FROM calendar", "calendar"),
        "missing_months": sql("SELECT month FROM calendar WHERE month NOT IN (SELECT snapdate FROM labels)", "calendar"),
        "latest_snapshot": sql("SELECT * FROM labels WHERE snapdate = (SELECT max(snapdate) FROM labels)", "labels"),
        "snapshot_range": sql(f"SELECT * FROM labels WHERE snapdate BETWEEN DATE '{TRAIN[0]}' AND DATE '{TRAIN[1]}'", "labels"),
        "snapshot_month_columns": sql("""
            SELECT *, CAST(year(snapdate) AS INTEGER) AS year, CAST(month(snapdate) AS INTEGER) AS month,
                   strftime(snapdate, '%Y-%m') AS year_month FROM labels""", "labels"),
        "month_range_split": sql(f"SELECT * FROM (SELECT *, {RANGE_CASE} AS dataset FROM labels) q WHERE dataset IS NOT NULL",
                                 "labels"),
        "time_split": sql("SELECT l.*, split FROM labels l JOIN month_split s ON date_trunc('month', l.snapdate) = s.m",
                          "labels", "month_split"),
        "split_summary": sql("SELECT split, count(*) AS n FROM labels l JOIN month_split s "
                             "ON date_trunc('month', l.snapdate) = s.m GROUP BY split", "labels", "month_split"),
        "normalize_key": sql("SELECT trim(customerID) AS customerID, snapdate, Churn, ord_ FROM fx_label", "fx_label"),
        "drop_unknown_rows": sql(f"SELECT * FROM fx_service WHERE {complete('InternetService', 'StreamingTV')}", "fx_service"),
        "sanitize_tokens": sql("SELECT customerID, ord_, " + ", ".join(
            f"CASE WHEN {norm(c)} NOT IN {TOKENS} THEN {c} END AS {c}" for c in DEMO) + " FROM fx_demographic", "fx_demographic"),
        "fill_missing": sql("SELECT customerID, ord_, " + ", ".join(
            f"coalesce({c}, (SELECT median({c}) FROM financial)) AS {c}" for c in FENCE_COLS)
            + ", CustomerSatisfactionScore FROM financial", "financial"),
        "null_profile": sql(" UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM fx_demographic"
            for c in ["customerID", *DEMO, "ord_"]), "fx_demographic"),
        "keep_last_per_key": sql(last_per("fx_demographic", "customerID", "* EXCLUDE (rn)"), "fx_demographic"),
        "unique_keys_only": sql("SELECT * FROM fx_service WHERE customerID IN "
                                "(SELECT customerID FROM fx_service GROUP BY customerID HAVING count(*) = 1)", "fx_service"),
        "dedup_report": sql("""
            SELECT snapdate, CAST(sum(c) AS BIGINT) AS rows_before,
                   CAST(coalesce(sum(c) FILTER (WHERE c = 1), 0) AS BIGINT) AS rows_after,
                   CAST(coalesce(sum(c) FILTER (WHERE c > 1), 0) AS BIGINT) AS dropped,
                   CASE WHEN max(c) > 1 THEN 'duplicates removed' ELSE 'no duplicates' END AS note
            FROM (SELECT snapdate, customerID, count(*) AS c FROM coded GROUP BY ALL) q GROUP BY snapdate""", "coded"),
        "keep_last_per_key_month": sql(last_per(
            "(SELECT trim(customerID) AS customerID, snapdate, Churn, ord_ FROM labels)", "customerID, snapdate",
            "* EXCLUDE (rn)"), "labels"),
        "training_frame": sql("SELECT * FROM training", "training"),
        "map_binary_label": sql("SELECT ord_, Churn, CASE lower(trim(Churn)) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS y "
                                "FROM fx_label", "fx_label"),
        "label_distribution": sql("""
            SELECT y, n, round(n / sum(n) OVER () + 1e-12, 9) AS rate FROM
            (SELECT y, count(*) AS n FROM coded GROUP BY y) q""", "coded"),
        "class_weights": sql("""
            SELECT y, n, round(sum(n) OVER () / (count(*) OVER () * n) + 1e-12, 9) AS w_balanced, round(max(n) OVER () / n + 1e-12, 9) AS w_max
            FROM (SELECT y, count(*) AS n FROM coded WHERE y IS NOT NULL GROUP BY y) q""", "coded"),
        "clean_yes_no": sql("SELECT customerID, ord_, Partner, Dependents FROM demographic", "demographic"),
        "clean_demographic": sql("SELECT * FROM demographic", "demographic"),
        "fuzzy_dictionary": sql(
            "SELECT DISTINCT s.\"column\", s.raw, s.best, CAST(s.score AS DOUBLE) AS score FROM seen f JOIN (VALUES "
            + ", ".join(f"({lit(c)}, {lit(v)}, {lit(r)}, {lit(b)}, {s})" for c, v, r, b, s in SCORED)
            + ") s(\"column\", v, raw, best, score) ON f.c = s.\"column\" AND f.v IS NOT DISTINCT FROM s.v",
            "fx_demographic",
            extra="seen AS (" + " UNION ALL ".join(
                f"SELECT DISTINCT '{c}' AS c, {c} AS v FROM fx_demographic" for c in DEMO) + ")"),
        "parse_number": sql("SELECT customerID, ord_, mc AS MonthlyCharges, du AS AverageDataUsage, al AS AppLoginFrequency "
                            "FROM nums", "nums"),
        "iqr_fences": sql('SELECT "column", round(q1 + 1e-12, 9) AS q1, round(q3 + 1e-12, 9) AS q3, '
                          'round(q3 + 3.0 * greatest(q3 - q1, 0.0) + 1e-12, 9) AS upper FROM fences', "fences"),
        "refund_split": sql("""
            SELECT customerID, round_even(CASE WHEN mc > u THEN u ELSE mc END * 100, 0) / 100 AS MonthlyCharges,
                   mc_raw AS MonthlyCharges_raw, coalesce(mc < 0, FALSE) AS MonthlyCharges_was_negative,
                   coalesce(mc > u, FALSE) AS MonthlyCharges_was_outlier,
                   CASE WHEN mc < 0 THEN abs(mc) ELSE 0.0 END AS MonthlyCharges_refund,
                   CASE WHEN mc < 0 THEN 0.0 ELSE mc END AS MonthlyCharges_paid_pos
            FROM nums, (SELECT q3 + 3.0 * greatest(q3 - q1, 0.0) AS u FROM (SELECT quantile_cont(mc, 0.25) AS q1,
                        quantile_cont(mc, 0.75) AS q3 FROM nums WHERE mc >= 0) a) b""", "nums"),
        "clean_financial": sql("SELECT MonthlyCharges, AverageDataUsage, AppLoginFrequency, CustomerSatisfactionScore, "
                               "customerID FROM financial", "financial"),
        "numeric_ratio": sql(" UNION ALL ".join(
            f"SELECT '{n}' AS \"column\", round(avg(CASE WHEN {r} IS NOT NULL THEN CASE WHEN {v} IS NOT NULL THEN 1 ELSE 0 END "
            f"END) + 1e-12, 9) AS ratio, coalesce(avg(CASE WHEN {r} IS NOT NULL THEN CASE WHEN {v} IS NOT NULL THEN 1 ELSE 0 END END) "
            f">= 0.9, FALSE) AS mostly_numeric FROM nums"
            for n, r, v in zip(FENCE_COLS, ("mc_raw", "du_raw", "al_raw"), ("mc", "du", "al"))), "nums"),
        "clean_contract": sql("SELECT * FROM contract", "contract"),
        "clean_service": sql("SELECT * FROM service", "service"),
        "union_snapshots": sql("""
            SELECT customerID, snapdate, Churn, ord_, CAST(NULL AS VARCHAR) AS channel FROM labels
            WHERE snapdate < DATE '1998-05-01'
            UNION ALL SELECT customerID, snapdate, Churn, ord_, 'web' FROM labels
            WHERE snapdate >= DATE '1998-05-01'""", "labels"),
        "binary_column_scan": sql(" UNION ALL ".join(
            f"SELECT '{n}' AS \"column\", coalesce(bool_and({e} IN (0, 1)), TRUE) AS is_binary FROM financial" for n, e in (
                ("negative", "CAST(mc_neg AS INTEGER)"), ("outlier", "CAST(mc_out AS INTEGER)"),
                ("MonthlyCharges", "MonthlyCharges"), ("AppLoginFrequency", "AppLoginFrequency"))), "financial"),
        "align_to_schema": sql("SELECT y, customerID, CAST(0 AS DOUBLE) AS tenure, CAST('0' AS VARCHAR) AS region FROM coded",
                               "coded"),
        "date_features": """
            SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS o_orderdate_day,
                   CAST(isodow(o_orderdate) - 1 AS INTEGER) AS o_orderdate_dayofweek,
                   CAST(quarter(o_orderdate) AS INTEGER) AS o_orderdate_quarter FROM orders""",
        "impute_median": sql("SELECT customerID, ord_, " + ", ".join(
            f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM financial)) AS {c}" for c in FENCE_COLS)
            + " FROM financial", "financial"),
        "impute_mode": sql("SELECT customerID, ord_, " + ", ".join(
            f"coalesce({c}, (SELECT v FROM mode_of WHERE col = '{c}')) AS {c}" for c in DEMO) + " FROM demographic",
            "demographic", extra=MODE_PART),
        "scale_by_std": sql("SELECT customerID, ord_, " + ", ".join(
            f"round({c} / (SELECT CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END FROM imp) + 1e-12, 9) AS {c}"
            for c in FENCE_COLS) + " FROM imp", "financial",
            extra="imp AS (SELECT customerID, ord_, " + ", ".join(
                f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM financial)) AS {c}" for c in FENCE_COLS)
            + " FROM financial)"),
        "rare_category_pooling": sql("""
            SELECT ord_, CASE WHEN n >= 10 THEN c ELSE '__infrequent__' END AS customerID
            FROM (SELECT ord_, trim(customerID) AS c, count(*) OVER (PARTITION BY trim(customerID)) AS n FROM fx_label) q""",
            "fx_label"),
        "model_matrix": sql("""
            SELECT customerID, Churn, CAST(day(snapdate) AS DOUBLE) AS snapdate_day,
                   CAST(isodow(snapdate) - 1 AS DOUBLE) AS snapdate_dayofweek, CAST(quarter(snapdate) AS DOUBLE) AS snapdate_quarter,
                   coalesce(MonthlyCharges, (SELECT median(MonthlyCharges) FROM train_matrix)) AS MonthlyCharges,
                   coalesce(AverageDataUsage, (SELECT median(AverageDataUsage) FROM train_matrix)) AS AverageDataUsage,
                   coalesce(CAST(AppLoginFrequency AS DOUBLE), (SELECT median(AppLoginFrequency) FROM train_matrix)) AS AppLoginFrequency,
                   coalesce(gender, 'Unknown') AS gender, coalesce(EducationLevel, 'Unknown') AS EducationLevel
            FROM train_matrix""", "train_matrix"),
        "stratified_split": sql("SELECT doc_id, quality, CASE WHEN rn - 1 < 0.2 * n THEN 'test' ELSE 'train' END AS part "
                                "FROM ranked", extra=SPLIT_PART),
        "stratified_split_by_month": sql(
            "SELECT customerID, snapdate, ord_, y, CASE WHEN y IS NOT NULL AND rn - 1 < 0.2 * n THEN 'test' ELSE 'train' END AS part "
            "FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY h) AS rn, count(*) OVER (PARTITION BY y) AS n FROM (SELECT *, "
            "md5(concat_ws('|', customerID, CAST(snapdate AS VARCHAR), CAST(ord_ AS VARCHAR)) || ':42') AS h FROM coded) a) b", "coded"),
        "csv_round_trip": sql(
            "SELECT customerID, EducationLevel, CASE WHEN AnnualIncomeBracket = 'n / a' THEN AnnualIncomeBracket ELSE AnnualIncomeBracket END "
            "AS AnnualIncomeBracket, CAST(ord_ AS VARCHAR) AS ord_, CASE WHEN ord_ % 2 = 0 THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END "
            "AS snapdate FROM fx_demographic", "fx_demographic"),
        "logreg_optimality": sql(
            "SELECT 'n_chars' AS feature, TRUE AS stationary UNION ALL SELECT DISTINCT 'lang_' || CASE WHEN n < 10 THEN '__infrequent__' ELSE lang END, TRUE "
            "FROM (SELECT lang, count(*) AS n FROM train_docs GROUP BY lang) a UNION ALL SELECT DISTINCT 'source_' || CASE WHEN n < 10 THEN "
            "'__infrequent__' ELSE source END, TRUE FROM (SELECT source, count(*) AS n FROM train_docs GROUP BY source) b",
            extra=SPLIT_PART + ",\ntrain_docs AS (SELECT d.* FROM documents d JOIN ranked r USING (doc_id) WHERE rn - 1 >= 0.2 * n)"),
        "boosting_rounds": ranking("SELECT model, round, round(auc + 1e-12, 9) AS auc FROM rank_metrics", "model, round", "staged", "staged"),
        "boosting_best_round": ranking("""
            SELECT model, best_round, round(best_auc + 1e-12, 9) AS best_auc, CAST(least(best_round + 3, 12) AS INTEGER) AS last_round, best_round + 3 <= 12 AS stopped
            FROM (SELECT a.model, min(a.round) AS best_round, min_by(a.auc, a.round) AS best_auc FROM rank_metrics a
                  WHERE NOT EXISTS (SELECT 1 FROM rank_metrics b WHERE b.model = a.model AND b.round < a.round AND b.auc >= a.auc)
                    AND NOT EXISTS (SELECT 1 FROM rank_metrics c WHERE c.model = a.model AND c.round > a.round AND c.round <= a.round + 3
                                    AND c.auc > a.auc)
                  GROUP BY a.model) best""", "model, round", "staged", "staged"),
        "target_encoding": sql(f"""
            SELECT doc_id, part, {", ".join(f"""round((coalesce({c}_all.s, 0) - CASE WHEN part = 'test' THEN 0 ELSE coalesce({c}_own.s, 0) END + 10 * prior)
                   / (coalesce({c}_all.n, 0) - CASE WHEN part = 'test' THEN 0 ELSE coalesce({c}_own.n, 0) END + 10) + 1e-12, 9) AS {c}_mean""" for c in ("lang", "source"))}
            FROM (SELECT k.*, CASE WHEN part = 'test' THEN t.s / t.n ELSE (t.s - o.s) / (t.n - o.n) END AS prior
                  FROM known k, (SELECT CAST(sum(quality) AS DOUBLE) AS s, count(*) AS n FROM train_docs) t
                  LEFT JOIN (SELECT fold, sum(quality) AS s, count(*) AS n FROM train_docs GROUP BY fold) o ON o.fold = k.fold) d
            {" ".join(f"""LEFT JOIN (SELECT {c}, sum(quality) AS s, count(*) AS n FROM train_docs GROUP BY {c}) {c}_all ON {c}_all.{c} = d.{c}
            LEFT JOIN (SELECT {c}, fold, sum(quality) AS s, count(*) AS n FROM train_docs GROUP BY {c}, fold) {c}_own
              ON {c}_own.{c} = d.{c} AND {c}_own.fold = d.fold""" for c in ("lang", "source"))}""",
            extra=SPLIT_PART + f""",
known AS (SELECT d.doc_id, d.lang, d.source, r.quality, CASE WHEN rn - 1 < 0.2 * n THEN 'test' ELSE 'train' END AS part, {fold('doc_id')} AS fold
          FROM documents d JOIN ranked r USING (doc_id)),
train_docs AS (SELECT * FROM known WHERE part = 'train')"""),
        "target_encoding_table": sql("""
            SELECT 'customerID' AS "column", value, place, round((coalesce(sum(y) FILTER (fold <> place - 1), 0) + 10 * any_value(prior))
                   / (count(*) FILTER (fold <> place - 1) + 10) + 1e-12, 9) AS mean
            FROM order_churn, (SELECT place, avg(y) FILTER (fold <> place - 1) AS prior FROM order_churn, (SELECT CAST(unnest(range(6)) AS INTEGER) AS place) p
                               GROUP BY place) priors
            GROUP BY value, place""", "order_churn"),
        "gbt_agreement": sql("SELECT doc_id, quality, CASE WHEN rn - 1 < 0.2 * n THEN 'test' ELSE 'train' END AS part, TRUE AS agrees "
                             "FROM ranked", extra=SPLIT_PART),
        "batch_score_agreement": sql(
            "SELECT customerID, CASE lower(Churn) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS y, TRUE AS agrees FROM gold "
            "WHERE snapdate = (SELECT max(snapdate) FROM gold)", "gold"),
        "monitor_counts": sql(
            "SELECT model, CAST(date_trunc('month', snapdate) AS DATE) AS month, count(*) AS n, count(*) FILTER (lower(Churn) = 'yes') AS positives "
            "FROM gold, (SELECT unnest(['logreg', 'trees']) AS model) m WHERE lower(Churn) IN ('yes', 'no') "
            f"AND snapdate BETWEEN DATE '{OOT[0]}' AND DATE '{OOT[1]}' GROUP BY ALL", "gold"),
        "end_to_end_counts": sql(f"""
            SELECT 'gold' AS stage, count(*) AS n FROM gold
            UNION ALL SELECT 'monitor', 2 * count(DISTINCT snapdate) FROM gold WHERE {IN_OOT} AND {LABELLED}
            UNION ALL SELECT unnest(['logistic_predictions', 'trees_predictions']), n
                FROM (SELECT count(*) AS n FROM gold WHERE snapdate = (SELECT max(snapdate) FROM gold)) newest
            UNION ALL SELECT 'logistic_scores', count(*) FROM gold WHERE {IN_TRAIN} AND {LABELLED}
            UNION ALL SELECT 'trees_scores', CAST(count(*) FILTER ({IN_OOT}) + ceil(0.2 * count(*) FILTER ({IN_TRAIN} AND lower(Churn) = 'yes'))
                + ceil(0.2 * count(*) FILTER ({IN_TRAIN} AND lower(Churn) = 'no')) AS BIGINT) FROM gold WHERE {LABELLED}""", "gold"),
        "confusion_matrix": sql(f"SELECT model, month, {CELLS} FROM fx_scores GROUP BY model, month", "fx_scores"),
        "threshold_metrics": sql(f"SELECT model, month, round({ACC} + 1e-12, 9) AS accuracy, round({PREC} + 1e-12, 9) AS precision, "
                                 f"round({REC} + 1e-12, 9) AS recall, round({F1} + 1e-12, 9) AS f1 FROM "
                                 f"(SELECT model, month, {CELLS} FROM fx_scores GROUP BY model, month) q", "fx_scores"),
        "classification_report": sql("SELECT model, label, " + rounded("precision", "recall", "f1") + ", support FROM lines",
                                     "fx_scores", extra=REPORT_PART),
        "calibration_metrics": sql("SELECT model, month, " + rounded("brier", "logloss", "pred_mean", "pred_std")
                                   + ", positives, negatives, n FROM "
                                   f"(SELECT model, month, {CALIBRATION} FROM fx_scores GROUP BY model, month) q", "fx_scores"),
        "monthly_metrics": ranking(
            "SELECT model, month, " + rounded("auc", "average_precision", "ks")
            + f", CASE WHEN auc IS NOT NULL THEN round({F1} + 1e-12, 9) END AS f1"
            + f", CASE WHEN auc IS NOT NULL THEN round({PREC} + 1e-12, 9) END AS precision"
            + f", CASE WHEN auc IS NOT NULL THEN round({REC} + 1e-12, 9) END AS recall, round({ACC} + 1e-12, 9) AS accuracy, "
            + rounded("brier", "logloss", "pred_mean", "pred_std") + ", positives, negatives, n FROM "
            + f"(SELECT model, month, {CELLS}, {CALIBRATION} FROM fx_scores GROUP BY model, month) q "
            + "JOIN rank_metrics USING (model, month)", "model, month", "fx_scores", "fx_scores"),
        "evaluation_by_dataset": ranking(
            f"SELECT model, dataset, tn, fp, fn, tp, round({ACC} + 1e-12, 9) AS accuracy, round({PREC} + 1e-12, 9) AS precision, "
            f"round({REC} + 1e-12, 9) AS recall, round({F1} + 1e-12, 9) AS f1, round(auc + 1e-12, 9) AS auc FROM "
            f"(SELECT model, dataset, {CELLS} FROM marked GROUP BY model, dataset) q JOIN rank_metrics USING (model, dataset)",
            "model, dataset", "marked", "marked"),
        "metrics_long": ranking(
            " UNION ALL ".join(f'SELECT model, dataset AS "Dataset", \'{name}\' AS "Metric", round({e} + 1e-12, 9) AS "Value" FROM both_'
                               for name, e in (("Accuracy", ACC), ("AUC-ROC", "auc"), ("Precision", PREC), ("Recall", REC))),
            "model, dataset", "marked", "marked").replace(
                "\nSELECT model, dataset AS", ", both_ AS (SELECT * FROM (SELECT model, dataset, " + CELLS
                + " FROM marked GROUP BY model, dataset) q JOIN rank_metrics USING (model, dataset))\nSELECT model, dataset AS", 1),
        "prediction_summary": sql("""
            SELECT model, count(*) FILTER (WHERE p < 0.5) AS n_0, count(*) FILTER (WHERE p >= 0.5) AS n_1,
                   round(avg(p) + 1e-12, 9) AS pred_mean FROM fx_scores GROUP BY model""", "fx_scores"),
        "score_histogram": sql(f"""
            SELECT model, CAST(c.bin AS INTEGER) AS bin, count(s.model) AS n FROM (SELECT * FROM
              (SELECT DISTINCT model FROM fx_scores) m, (SELECT unnest(range(10)) AS bin) r) c
            LEFT JOIN (SELECT model, {BIN} AS bin FROM fx_scores) s USING (model, bin) GROUP BY model, c.bin""", "fx_scores"),
        "psi": sql("SELECT round(psi + 1e-12, 9) AS psi FROM index", "fx_scores", extra=psi_sql(
            "fx_scores", "CASE model WHEN 'a' THEN 'expected' ELSE 'actual' END", [])),
        "psi_grade": sql("SELECT model, round(psi + 1e-12, 9) AS psi, CASE WHEN psi < 0.1 THEN 'good' WHEN psi < 0.2 THEN 'attention' "
                         "ELSE 'drifted' END AS grade FROM index", "fx_scores", extra=psi_sql("fx_scores", MARK_SIDE, ["model"])),
        "layer_row_counts": sql(" UNION ALL ".join(
            [f"SELECT 'bronze' AS layer, '{t}' AS \"table\", count(*) AS n FROM {s}" for t, s in (
                ("label", "labels"), ("contract", "fx_contract"), ("service", "fx_service"),
                ("demographic", "fx_demographic"), ("financial", "fx_financial"))]
            + [f"SELECT 'silver', '{t}', count(*) FROM {s}" for t, s in (
                ("label", "labels"), ("contract", "contract"), ("service", "service"), ("demographic", "demographic"),
                ("financial", "financial"))]
            + ["SELECT 'gold', 'gold', count(*) FROM gold"]), "gold"),
    }
    even = "CAST(substr(customerID, 2) AS BIGINT) % 2 = 0"
    entries = [(f"bronze/{t}", 1, f"fx_{t}", "labels" if t == "label" else f"fx_{t}", "TRUE") for t in ("label", "contract", "service", "demographic", "financial")]
    entries += [("silver/label", 1, "labels", "labels", "TRUE"), *[(f"silver/{t}", 1, f"fx_{t}", t, "TRUE") for t in ("contract", "service", "demographic", "financial")],
                ("gold/gold", 1, "labels", "gold", "TRUE"), ("bronze/contract", 2, "fx_contract", "fx_contract", even), ("silver/contract", 2, "fx_contract", "contract", even),
                ("gold/gold", 2, "labels", "gold", even)]
    out["run_ledger"] = sql("SELECT *, greatest(rows_in - rows_out, 0) AS rejected FROM (" + " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, {run} AS run, (SELECT count(*) FROM {before}{'' if before == 'labels' else ' WHERE ' + where}) AS rows_in, "
        f"(SELECT count(*) FROM {after} WHERE {where}) AS rows_out" for stage, run, before, after, where in entries) + ") e", "gold", "labels", "contract", "service")
    out |= {"grown_dictionary": out["clean_demographic"], "stored_fences": out["clean_financial"]}
    out |= {"score_state_metrics": out["monthly_metrics"], "score_state_psi": out["psi_grade"]}
    for name, cols in FULL_FLAGS.items():
        out[name] = sql(f"SELECT customerID, {cols} FROM financial", "financial")
    for name, col in (("clean_gender", "gender"), ("clean_education", "EducationLevel"),
                      ("clean_employment", "EmploymentStatus"), ("clean_income_bracket", "AnnualIncomeBracket")):
        out[name] = sql(f"SELECT customerID, ord_, {col} FROM demographic", "demographic")
    for name, metric in (("auc_by_month", "auc"), ("average_precision_by_month", "average_precision"), ("ks_by_month", "ks")):
        out[name] = ranking(f"SELECT model, month, {rounded(metric)} FROM rank_metrics", "model, month", "fx_scores", "fx_scores")
    return out
