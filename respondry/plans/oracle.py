"""The same results in plain SQL over the given tables, written independently of the operators.

Texts and category lists are spelled out, so nothing is shared with them.
"""

from __future__ import annotations

# fixed values: message texts, spelled out here so that the check does not share them
ACTION_TEXTS = {
    "urgent": "紧急：安排立即个人联系。提供客户保留计划和财务咨询。",
    "high_priority": "高优先级：启动客户保留活动。考虑基于以往互动的个性化优惠。",
    "attention": "需要关注：密切监控账户。考虑主动信贷咨询或重组选项。",
    "moderate": "中等关注：纳入下次外联活动。评估产品适合度和满意度。",
    "routine": "常规：通过标准营销渠道保持定期互动。",
}
BASE_TEXTS = {
    "High Potential": "高级营销活动：直接个人电话联系，提供优质的定期存款产品，降低利率门槛",
    "Medium Potential": "标准营销活动：先发送邮件，然后电话跟进，提供常规定期存款产品",
    "Low Potential": "基础营销活动：群发邮件提供基本定期存款信息，定期更新",
}
CHURN_TEXTS = {
    "High Churn Risk": "。紧急提示：增加客户保留激励措施，如专属利率或增值服务",
    "Medium Churn Risk": "。建议：包含忠诚度奖励，如期限灵活性或特殊优惠",
}
CREDIT_TEXTS = {
    "High Credit Risk": "。风险提示：推荐保守型金融产品，降低风险敞口",
}
COLUMNS = (
    "age", "job", "marital", "education", "default", "housing", "loan", "contact", "month",
    "day_of_week", "duration", "campaign", "pdays", "previous", "poutcome", "emp_var_rate",
    "cons_price_idx", "cons_conf_idx", "euribor3m", "nr_employed", "y",
)

CONTACTS = """
base AS (
  SELECT *, year(o_orderdate) * 12 + month(o_orderdate) AS ym,
         CASE WHEN c_custkey % 3 <> 0 THEN 999 ELSE CAST((o_orderkey * 13) % 120 AS INT) END AS pd
  FROM orders JOIN customer ON o_custkey = c_custkey
),
contacts AS (
  SELECT
    o_orderkey AS contact_id,
    CAST(17 + (c_custkey * 31) % 90 AS INT) AS age,
    CASE WHEN c_custkey % 11 = 0 THEN 'unknown'
         WHEN c_mktsegment = 'AUTOMOBILE' THEN 'technician'
         WHEN c_mktsegment = 'BUILDING' THEN 'blue-collar'
         WHEN c_mktsegment = 'HOUSEHOLD' THEN 'housemaid'
         WHEN c_mktsegment = 'MACHINERY' THEN 'admin.' ELSE lower(c_mktsegment) END AS job,
    CASE WHEN c_custkey % 53 = 0 THEN 'unknown' WHEN c_nationkey % 4 = 1 THEN 'single'
         WHEN c_nationkey % 4 = 2 THEN 'divorced' ELSE 'married' END AS marital,
    CASE c_custkey % 8 WHEN 0 THEN 'basic.4y' WHEN 1 THEN 'basic.6y' WHEN 2 THEN 'basic.9y'
         WHEN 3 THEN 'high.school' WHEN 4 THEN 'professional.course' WHEN 5 THEN 'unknown'
         ELSE 'university.degree' END AS education,
    CASE WHEN c_acctbal < -500 THEN 'yes' WHEN c_custkey % 5 = 0 THEN 'unknown' ELSE 'no' END
      AS "default",
    CASE WHEN c_custkey % 41 = 0 THEN 'unknown' WHEN c_custkey % 2 = 0 THEN 'yes' ELSE 'no' END
      AS housing,
    CASE WHEN c_custkey % 41 = 0 THEN 'unknown' WHEN c_custkey % 6 = 0 THEN 'yes' ELSE 'no' END
      AS loan,
    CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2', '3') THEN 'cellular'
         ELSE 'telephone' END AS contact,
    CASE month(o_orderdate) WHEN 1 THEN 'jan' WHEN 2 THEN 'feb' WHEN 3 THEN 'mar' WHEN 4 THEN 'apr'
         WHEN 5 THEN 'may' WHEN 6 THEN 'jun' WHEN 7 THEN 'jul' WHEN 8 THEN 'aug' WHEN 9 THEN 'sep'
         WHEN 10 THEN 'oct' WHEN 11 THEN 'nov' ELSE 'dec' END AS month,
    CASE o_orderkey % 5 WHEN 0 THEN 'mon' WHEN 1 THEN 'tue' WHEN 2 THEN 'wed' WHEN 3 THEN 'thu'
         ELSE 'fri' END AS day_of_week,
    CAST(o_orderkey % 600 AS INT) AS duration,
    CAST(1 + (o_orderkey * 7) % 9 AS INT) AS campaign,
    CAST(pd AS INT) AS pdays,
    CASE WHEN pd = 999 THEN 0 ELSE CAST(o_orderkey % 4 AS INT) END AS previous,
    CASE WHEN pd = 999 THEN 'nonexistent' WHEN o_orderkey % 4 = 1 THEN 'success'
         ELSE 'failure' END AS poutcome,
    CAST(ym % 49 - 34 AS DOUBLE) / 10 AS emp_var_rate,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(922 + ym % 27 AS DOUBLE) / 10 END
      AS cons_price_idx,
    CAST((o_orderkey * 29 + ym) % 340 - 508 AS DOUBLE) / 10 AS cons_conf_idx,
    CAST(6 + o_orderkey % 45 AS DOUBLE) / 10 AS euribor3m,
    CAST(4963 + (ym * 7) % 266 AS DOUBLE) AS nr_employed,
    CASE WHEN (o_orderkey * 17 + c_custkey) % 100
              < CASE WHEN pd = 999 THEN 6 WHEN o_orderkey % 4 = 1 THEN 55 ELSE 15 END
         THEN 'yes' ELSE 'no' END AS y,
    (o_orderkey * 37 + c_custkey * 11) % 701 AS h
  FROM base
)"""

CATEGORICAL = ["job", "marital", "education", "default", "housing", "loan", "contact", "month",
               "day_of_week", "poutcome"]
NUMERIC = ["age", "campaign", "pdays", "previous", "emp_var_rate", "cons_price_idx",
           "cons_conf_idx", "euribor3m", "nr_employed"]
MACRO = NUMERIC[4:]
STRINGS = [*CATEGORICAL, "y"]


def q(name: str) -> str:
    return f'"{name}"'


def with_contacts(*parts: str) -> str:
    """A query whose last part is the final SELECT and whose others are named tables."""
    return "WITH " + ",\n".join([CONTACTS, *parts[:-1]]) + "\n" + parts[-1]


def hashed(key: str, salt: str) -> str:
    return f"('0x' || substr(md5({key}::VARCHAR || {salt}), 1, 8))::BIGINT"


SPLIT = (
    f"CASE WHEN {hashed('contact_id', chr(39) + ':split:42' + chr(39))} < 3006477107 THEN 'train' "
    f"WHEN {hashed('contact_id', chr(39) + ':split:42' + chr(39))} < 3650722201 THEN 'val' "
    "ELSE 'test' END"
)

# --- cleaning ------------------------------------------------------------------------------

MARKED = "marked AS (SELECT * EXCLUDE (h) REPLACE (%s) FROM contacts)" % ", ".join(
    f"nullif({q(c)}, 'unknown') AS {q(c)}" for c in STRINGS
)
MODE_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS c, {q(c)} AS v, count(*) AS n FROM marked WHERE {q(c)} IS NOT NULL GROUP BY ALL"
    for c in STRINGS
)
FILLS = (
    f"value_counts AS ({MODE_ROWS}), "
    "modes AS (SELECT c, v FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY n DESC, v) r "
    "FROM value_counts) WHERE r = 1)"
)
FILL_LIST = ", ".join(
    [f"coalesce({q(c)}, (SELECT v FROM modes WHERE c = '{c}')) AS {q(c)}" for c in STRINGS]
    + [f"coalesce({c}, (SELECT avg({c}) FROM marked)) AS {c}" for c in MACRO]
)
CLEANED = (
    MARKED, FILLS,
    f"cleaned AS (SELECT * EXCLUDE (duration) REPLACE ({FILL_LIST}) FROM marked "
    "WHERE age BETWEEN 18 AND 100)",
)

# --- features ------------------------------------------------------------------------------

INDEX_ROWS = " UNION ALL ".join(
    f"SELECT {i} AS ci, '{c}' AS c, {q(c)} AS v, count(*) AS n FROM cleaned GROUP BY ALL"
    for i, c in enumerate(CATEGORICAL)
)
NUMBERED = (
    f"numbered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY n DESC, v) - 1 AS idx, "
    f"count(*) OVER (PARTITION BY c) AS labels FROM ({INDEX_ROWS}))"
)
LONG_CATEGORIES = "long_categories AS (%s)" % " UNION ALL ".join(
    f"SELECT contact_id, '{c}' AS c, {q(c)} AS v FROM cleaned" for c in CATEGORICAL
)
BLOCKS = (
    "blocks AS (SELECT c, min(ci) AS ci, min(labels) - 1 AS slots FROM numbered GROUP BY c), "
    "starts AS (SELECT c, coalesce(sum(slots) OVER (ORDER BY ci ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND 1 PRECEDING), 0) AS start FROM blocks), "
    "width AS (SELECT sum(slots) AS slots FROM blocks)"
)
SCALES = "scales AS (SELECT %s FROM cleaned)" % ", ".join(
    f"stddev_samp({c}) AS s_{c}" for c in NUMERIC
)
LONG_NUMERIC = "long_numeric AS (%s)" % " UNION ALL ".join(
    f"SELECT contact_id, {i} AS i, {c} / (SELECT s_{c} FROM scales) AS value FROM cleaned"
    for i, c in enumerate(NUMERIC)
)
ENTRIES = (
    "entries AS ("
    "SELECT contact_id, CAST(start + idx AS INT) AS position, CAST(1 AS DOUBLE) AS value "
    "FROM long_categories JOIN numbered USING (c, v) JOIN starts USING (c) WHERE idx < labels - 1 "
    "UNION ALL SELECT contact_id, CAST((SELECT slots FROM width) + i AS INT), value "
    "FROM long_numeric WHERE value <> 0)"
)
FEATURES = (*CLEANED, NUMBERED, LONG_CATEGORIES, BLOCKS, SCALES, LONG_NUMERIC, ENTRIES)

# --- scores --------------------------------------------------------------------------------

SCORED = (
    "scored AS (SELECT * EXCLUDE (h), "
    "CAST(CASE WHEN y = 'yes' THEN h + 300 ELSE h + 150 END AS DOUBLE) / 1000 AS p_yes, "
    "CASE WHEN CAST(CASE WHEN y = 'yes' THEN h + 300 ELSE h + 150 END AS DOUBLE) / 1000 > 0.5 "
    "THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction FROM contacts)"
)
SEGMENTED = (
    SCORED,
    "segmented AS (SELECT *, CASE WHEN p_yes > 0.8 THEN 'High Potential' "
    "WHEN p_yes >= 0.5 THEN 'Medium Potential' ELSE 'Low Potential' END AS potential_segment "
    "FROM scored)",
)
ASSESSED = (
    *SEGMENTED,
    "outcomes AS (SELECT poutcome AS o, row_number() OVER (ORDER BY count(*) DESC, poutcome) - 1 "
    "AS oi FROM segmented GROUP BY poutcome)",
    "points AS (SELECT *, CAST(CASE potential_segment "
    "WHEN 'Low Potential' THEN CASE WHEN pdays > 90 THEN 40 ELSE 20 END "
    "+ CASE WHEN campaign > 5 THEN 30 ELSE 15 END + CASE WHEN previous < 2 THEN 30 ELSE 10 END "
    "WHEN 'Medium Potential' THEN CASE WHEN pdays > 60 THEN 35 ELSE 15 END "
    "+ CASE WHEN campaign > 3 THEN 25 ELSE 10 END + CASE WHEN oi < 0.5 THEN 25 ELSE 5 END "
    "WHEN 'High Potential' THEN CASE WHEN pdays > 30 THEN 25 ELSE 10 END "
    "+ CASE WHEN previous < 1 THEN 15 ELSE 5 END ELSE 10 END AS INT) AS churn_risk_score, "
    "CAST(CASE WHEN cons_conf_idx < -40 THEN 50 WHEN cons_conf_idx < -20 THEN 30 ELSE 10 END "
    "+ CASE WHEN \"default\" = 'yes' THEN 50 ELSE 0 END + CASE WHEN loan = 'yes' THEN 15 ELSE 0 END "
    "+ CASE WHEN housing = 'yes' THEN 15 ELSE 0 END AS INT) AS credit_risk_score "
    "FROM segmented LEFT JOIN outcomes ON poutcome = o)",
    "assessed AS (SELECT *, "
    "CASE WHEN churn_risk_score >= 70 THEN 'High Churn Risk' WHEN churn_risk_score >= 40 "
    "THEN 'Medium Churn Risk' ELSE 'Low Churn Risk' END AS churn_risk, "
    "CASE WHEN churn_risk_score >= 85 THEN 'Very High' WHEN churn_risk_score >= 70 THEN 'High' "
    "WHEN churn_risk_score >= 55 THEN 'Medium' WHEN churn_risk_score >= 40 THEN 'Low' "
    "ELSE 'Very Low' END AS churn_confidence, "
    "CASE WHEN credit_risk_score >= 60 THEN 'High Credit Risk' WHEN credit_risk_score >= 30 "
    "THEN 'Medium Credit Risk' ELSE 'Low Credit Risk' END AS credit_risk, "
    "CASE WHEN credit_risk_score >= 75 THEN 'Very High' WHEN credit_risk_score >= 60 THEN 'High' "
    "WHEN credit_risk_score >= 45 THEN 'Medium' WHEN credit_risk_score >= 30 THEN 'Low' "
    "ELSE 'Very Low' END AS credit_confidence, "
    "CAST(6 * churn_risk_score + 4 * credit_risk_score AS DOUBLE) / 10 AS composite_risk_score, "
    "CASE WHEN CAST(6 * churn_risk_score + 4 * credit_risk_score AS DOUBLE) / 10 >= 65 "
    "THEN 'High Risk' WHEN CAST(6 * churn_risk_score + 4 * credit_risk_score AS DOUBLE) / 10 >= 35 "
    "THEN 'Medium Risk' ELSE 'Low Risk' END AS overall_risk_level FROM points)",
    "advised AS (SELECT *, CASE "
    "WHEN churn_risk = 'High Churn Risk' AND credit_risk = 'High Credit Risk' THEN 'urgent' "
    "WHEN churn_risk = 'High Churn Risk' THEN 'high_priority' "
    "WHEN credit_risk = 'High Credit Risk' THEN 'attention' "
    "WHEN churn_risk = 'Medium Churn Risk' AND credit_risk = 'Medium Credit Risk' THEN 'moderate' "
    "ELSE 'routine' END AS action_code, rank() OVER (ORDER BY composite_risk_score DESC) "
    "AS risk_priority_rank FROM assessed)",
    "actions(action_code, recommended_actions) AS (VALUES %s)" % ", ".join(
        f"('{code}', '{text}')" for code, text in ACTION_TEXTS.items()
    ),
    "final AS (SELECT * FROM advised JOIN actions USING (action_code))",
)
DECIDED = (
    SCORED,
    "banded AS (SELECT *, CASE WHEN p_yes > 0.8 THEN 'High Potential' WHEN p_yes >= 0.5 "
    "THEN 'Medium Potential' ELSE 'Low Potential' END AS potential FROM scored)",
    "ruled AS (SELECT *, CASE "
    "WHEN potential = 'Low Potential' AND (pdays > 90 OR campaign > 5) AND previous < 2 "
    "THEN 'High Churn Risk' "
    "WHEN potential = 'Medium Potential' AND (pdays > 60 OR campaign > 3) THEN 'Medium Churn Risk' "
    "WHEN potential = 'High Potential' AND pdays > 30 THEN 'Medium Churn Risk' "
    "ELSE 'Low Churn Risk' END AS churn_risk, "
    "CASE WHEN cons_conf_idx < -40 OR \"default\" = 'yes' THEN 'High Credit Risk' "
    "WHEN cons_conf_idx >= -40 AND cons_conf_idx < -20 AND (loan = 'yes' OR housing = 'yes') "
    "THEN 'Medium Credit Risk' ELSE 'Low Credit Risk' END AS credit_risk FROM banded)",
    "decided AS (SELECT *, CASE potential %s END || CASE churn_risk %s ELSE '' END "
    "|| CASE credit_risk %s ELSE '' END AS marketing_recommendation FROM ruled)" % tuple(
        " ".join(f"WHEN '{name}' THEN '{text}'" for name, text in texts.items())
        for texts in (
            BASE_TEXTS, CHURN_TEXTS, CREDIT_TEXTS,
        )
    ),
)

# --- metrics -------------------------------------------------------------------------------

LABELLED = (
    SCORED,
    f"labelled AS (SELECT contact_id, p_yes, prediction, CAST(y = 'yes' AS DOUBLE) AS label, "
    f"{SPLIT} AS split FROM scored)",
)


def curve_parts(by: str = "") -> tuple[str, ...]:
    over = f"PARTITION BY {by}" if by else ""
    keep = f"{by}, " if by else ""
    return (
        f"per_score AS (SELECT {keep}p_yes, sum(label) AS pos, sum(1 - label) AS neg "
        f"FROM labelled GROUP BY {keep}p_yes)",
        f"running AS (SELECT *, sum(pos) OVER down AS tp, sum(neg) OVER down AS fp, "
        f"sum(pos) OVER ({over}) AS p, sum(neg) OVER ({over}) AS n, "
        "lead(pos) OVER down_all AS pos_next, lead(neg) OVER down_all AS neg_next, "
        "row_number() OVER down_all AS place FROM per_score "
        f"WINDOW down AS ({over} ORDER BY p_yes DESC ROWS UNBOUNDED PRECEDING), "
        f"down_all AS ({over} ORDER BY p_yes DESC))",
        f"steps AS (SELECT *, fp / n AS x, tp / p AS y, tp / (tp + fp) AS pr, "
        "(fp - neg) / n AS x0, (tp - pos) / p AS y0, "
        "CASE WHEN tp - pos + fp - neg = 0 THEN 1 ELSE (tp - pos) / (tp - pos + fp - neg) END "
        "AS pr0 FROM running)",
    )


def metric_parts(by: str = "", source: str = "labelled") -> tuple[str, ...]:
    keep = f"{by}, " if by else ""
    same = f"a.{by} = b.{by} AND " if by else ""
    return (
        "classes(c) AS (VALUES (CAST(0 AS DOUBLE)), (CAST(1 AS DOUBLE)))",
        f"class_counts AS (SELECT {keep}c, count(*) FILTER (label = c) AS actual, "
        f"count(*) FILTER (prediction = c) AS guessed, "
        f"count(*) FILTER (label = c AND prediction = c) AS hits, count(*) AS total "
        f"FROM {source}, classes GROUP BY {keep}c)",
        f"class_scores AS (SELECT *, CASE WHEN guessed = 0 THEN 0 ELSE hits / guessed END AS pr, "
        "CASE WHEN actual = 0 THEN 0 ELSE hits / actual END AS re FROM class_counts)",
        f"weighted AS (SELECT {keep}round(sum(hits) / max(total), 9) AS accuracy, "
        "round(sum(actual * pr) / max(total), 9) AS weighted_precision, "
        "round(sum(actual * re) / max(total), 9) AS weighted_recall, "
        "round(sum(actual * CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END) "
        f"/ max(total), 9) AS f1 FROM class_scores {'GROUP BY ' + by if by else ''})",
    )


# --- oversampling --------------------------------------------------------------------------

POINTS = (
    *CLEANED,
    "train_rows AS (SELECT contact_id, CAST(y = 'yes' AS DOUBLE) AS label, [CAST(age AS DOUBLE), "
    "campaign * 5, least(pdays, 150), previous * 10, "
    "CASE WHEN \"default\" = 'yes' THEN 20 ELSE 0 END, CASE WHEN housing = 'yes' THEN 20 ELSE 0 END, "
    "CASE WHEN loan = 'yes' THEN 20 ELSE 0 END, "
    "CASE WHEN contact = 'cellular' THEN 20 ELSE 0 END] AS vec "
    f"FROM cleaned WHERE {SPLIT} = 'train')",
    "few AS (SELECT * FROM train_rows WHERE label = 1)",
    "pairs AS (SELECT a.contact_id, b.contact_id AS neighbour, %s AS d2 FROM few a JOIN few b "
    "ON a.contact_id <> b.contact_id)" % " + ".join(
        f"(a.vec[{i}] - b.vec[{i}]) * (a.vec[{i}] - b.vec[{i}])" for i in range(1, 9)
    ),
    "nearest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY contact_id "
    "ORDER BY d2, neighbour) - 1 AS place FROM pairs) WHERE place < 5)",
)
CREATED = (
    *POINTS,
    "need AS (SELECT (SELECT count(*) FROM train_rows WHERE label = 0) - count(*) AS missing, "
    "count(*) AS have FROM few)",
    "parents AS (SELECT *, (SELECT missing // have FROM need) + CASE WHEN row_number() OVER "
    "(ORDER BY " + hashed("contact_id", "':smote:extra:42'") + ", contact_id) "
    "<= (SELECT missing % have FROM need) THEN 1 ELSE 0 END AS copies FROM few)",
    "copies AS (SELECT contact_id, label, vec, CAST(unnest(range(copies)) AS BIGINT) AS copy "
    "FROM parents)",
    "drawn AS (SELECT *, " + hashed("contact_id", "':smote:pick:42:' || copy") + " % 5 AS place, "
    + hashed("contact_id", "':smote:step:42:' || copy") + " / 4294967296.0::DOUBLE AS step "
    "FROM copies)",
)

EMBEDDING_SIZES = (
    "WITH sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label), "
    "top AS (SELECT max(n) AS m FROM sizes) "
    "SELECT label, false AS is_synthetic, n AS count FROM sizes UNION ALL "
    "SELECT label, true, m - n FROM sizes, top WHERE m > n"
)

TRAIN_SIZES = (
    *CLEANED,
    f"rows_by AS (SELECT {SPLIT} AS split, CAST(y = 'yes' AS DOUBLE) AS label, count(*) AS n "
    "FROM cleaned GROUP BY ALL)",
)

# --- validation ----------------------------------------------------------------------------

LISTS = {
    "job": "'admin.', 'blue-collar', 'entrepreneur', 'housemaid', 'management', "
        "'retired', 'self-employed', 'services', 'student', 'technician', 'unemployed'",
    "marital": "'married', 'single', 'divorced'",
    "education": "'basic.4y', 'basic.6y', 'basic.9y', "
        "'high.school', 'illiterate', 'professional.course', 'university.degree'",
    "default": "'no', 'yes'",
    "housing": "'no', 'yes'",
    "loan": "'no', 'yes'",
    "contact": "'cellular', 'telephone'",
    "month": "'jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec'",
    "day_of_week": "'mon', 'tue', 'wed', 'thu', 'fri'",
    "poutcome": "'failure', 'nonexistent', 'success'",
}
LIMITS = {"age": "18 AND 95", "campaign": "1 AND 50", "pdays": "-1 AND 999", "previous": "0 AND 50"}
SOFT = {"age": "18 AND 90", "campaign": "1 AND 20", "previous": "0 AND 10",
        "emp_var_rate": "-3.4::DOUBLE AND 1.4::DOUBLE",
        "cons_price_idx": "92.2::DOUBLE AND 94.8::DOUBLE",
        "cons_conf_idx": "-50.8::DOUBLE AND -26.9::DOUBLE",
        "euribor3m": "0.6::DOUBLE AND 5.0::DOUBLE", "nr_employed": "4963 AND 5228"}


def rule_list() -> list[tuple[str, str, str]]:
    """``(rule, kind, condition)``."""
    errors, warnings = [], []
    for c in [*CATEGORICAL, *NUMERIC]:
        empty = f"{q(c)} IS NULL" + (f" OR {q(c)} = ''" if c in LISTS else "")
        errors.append((f"{c}:required", "error", f"({empty})"))
        if c in LISTS:
            errors.append((f"{c}:value", "error", f"{q(c)} <> '' AND {q(c)} NOT IN ({LISTS[c]})"))
        if c in LIMITS:
            errors.append((f"{c}:limit", "error", f"{c} NOT BETWEEN {LIMITS[c]}"))
        if c in SOFT:
            warnings.append((f"{c}:recommended", "warning", f"{c} NOT BETWEEN {SOFT[c]}"))
    return errors + warnings


def listed(kind: str) -> str:
    parts = [f"CASE WHEN {cond} THEN '{rule}' END" for rule, k, cond in rule_list() if k == kind]
    return f"concat_ws(',', {', '.join(parts)})"


def by_key(parts: tuple[str, ...], columns: str, table: str) -> str:
    return with_contacts(*parts, f"SELECT contact_id, {columns} FROM {table}")


def oracle_sql() -> dict[str, str]:
    whole = with_contacts("SELECT * EXCLUDE (h) FROM contacts")
    rounded_macro = ", ".join(f"round({c}, 6) AS {c}" for c in MACRO)
    risk_list = (
        "contact_id, overall_risk_level, churn_risk, credit_risk, composite_risk_score, "
        "recommended_actions"
    )
    bins = [("0-20", "s >= 0 AND s < 20"), ("20-40", "s >= 20 AND s < 40"),
            ("40-60", "s >= 40 AND s < 60"), ("60-80", "s >= 60 AND s < 80"),
            ("80-100", "s >= 80 AND s <= 100")]

    def histogram(rows):
        return with_contacts(
            *ASSESSED, "scores AS (SELECT composite_risk_score AS s FROM assessed)",
            " UNION ALL ".join(
                f"SELECT '{name}' AS bin, count(*) FILTER ({cond}) AS count FROM scores"
                for name, cond in rows
            ),
        )

    indicators = ["churn_risk_score", "credit_risk_score", "cons_conf_idx", "pdays", "campaign",
                  "previous"]
    names = ["churn risk", "credit risk", "cons conf idx", "pdays", "campaign", "previous"]
    correlations = " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, '{names[i]}' AS indicator_i, '{names[j]}' AS indicator_j, "
        f"round(corr({indicators[i]}, {indicators[j]}), 6) AS value FROM assessed"
        for i in range(6) for j in range(6)
    )
    strategies = [
        ("High Potential Only", "potential_segment = 'High Potential'"),
        ("High + Medium Potential", "potential_segment IN ('High Potential', 'Medium Potential')"),
        ("Random Sampling (30%)", hashed("contact_id", "':sample:42'") + " < 1288490188"),
    ]
    simulation = " UNION ALL ".join(
        f"SELECT '{name}' AS s, count(*) AS t, count(*) FILTER (prediction = 1) AS w "
        f"FROM segmented WHERE {cond}"
        for name, cond in strategies
    )
    audience = [
        by_key(SEGMENTED, "potential_segment, prediction", f"segmented WHERE {cond}")
        for _, cond in strategies
    ]
    feature_entries = with_contacts(
        *FEATURES, "SELECT contact_id, position, round(value, 6) AS value FROM entries"
    )
    typed = ", ".join(
        {"age": "CASE WHEN contact_id % 101 = 0 THEN NULL ELSE age END AS age",
         "euribor3m": "CASE WHEN contact_id % 103 = 0 THEN NULL ELSE euribor3m END AS euribor3m",
         }.get(c, q(c)) for c in [*CATEGORICAL, *NUMERIC]
    )
    curve = (*LABELLED, *curve_parts())
    curve_by = (*LABELLED, *curve_parts("split"))
    return {
        "scan_csv": whole,
        "normalize_names": whole,
        "scan_parquet": "SELECT * FROM customer",
        "roundtrip_parquet": whole,
        "row_key": with_contacts(
            "SELECT sha256(concat_ws(chr(31), " + ", ".join(
                f"coalesce({q(c)}::VARCHAR, chr(0))" for c in COLUMNS
            ) + ")) || '-' || row_number() OVER (PARTITION BY "
            + ", ".join(map(q, COLUMNS)) + ") AS row_key, age, job FROM contacts"
        ),
        "scan_csv_header": whole,
        "scan_csv_folder": whole,
        "feature_model_reload": feature_entries,
        "clean_sentinel": with_contacts(MARKED, "SELECT * FROM marked"),
        "impute_mean": with_contacts(
            "SELECT contact_id, " + ", ".join(
                f"round(coalesce({c}, (SELECT avg({c}) FROM contacts)), 6) AS {c}" for c in MACRO
            ) + " FROM contacts"
        ),
        "impute_mode": with_contacts(
            MARKED, FILLS,
            "SELECT contact_id, " + ", ".join(
                f"coalesce({q(c)}, (SELECT v FROM modes WHERE c = '{c}')) AS {q(c)}" for c in STRINGS
            ) + " FROM marked",
        ),
        "filter_range": with_contacts(
            "SELECT * EXCLUDE (h) FROM contacts WHERE age >= 18 AND age <= 100"
        ),
        "clean_full": with_contacts(
            *CLEANED, f"SELECT * REPLACE ({rounded_macro}) FROM cleaned"
        ),
        "index_categories": with_contacts(
            *CLEANED, NUMBERED, LONG_CATEGORIES,
            "SELECT contact_id, " + ", ".join(
                f"CAST(max(idx) FILTER (c = '{c}') AS DOUBLE) AS {c}_index" for c in CATEGORICAL
            ) + " FROM long_categories JOIN numbered USING (c, v) GROUP BY contact_id",
        ),
        "one_hot": with_contacts(
            *CLEANED, NUMBERED, LONG_CATEGORIES,
            'SELECT contact_id, c AS "column", CAST(idx AS INT) AS position FROM long_categories '
            "JOIN numbered USING (c, v) WHERE idx < labels - 1",
        ),
        "standard_scale": with_contacts(
            *CLEANED, SCALES,
            "SELECT contact_id, " + ", ".join(f"round({c} / s_{c}, 6) AS {c}" for c in NUMERIC)
            + " FROM cleaned, scales",
        ),
        "assemble_features": feature_entries,
        "label_index": by_key(CLEANED, "CAST(y = 'yes' AS DOUBLE) AS label", "cleaned"),
        "feature_table": with_contacts(
            *FEATURES,
            f"SELECT contact_id, {SPLIT} AS split, "
            "CAST((SELECT slots FROM width) + 9 AS INT) AS slots, round(total, 3) AS total, "
            "CAST(y = 'yes' AS DOUBLE) AS label FROM cleaned JOIN "
            "(SELECT contact_id, sum(value) AS total FROM entries GROUP BY contact_id) "
            "USING (contact_id)",
        ),
        "split_assign": with_contacts(f"SELECT contact_id, {SPLIT} AS split FROM contacts"),
        "split_sizes": with_contacts(
            *TRAIN_SIZES,
            "SELECT split, false AS is_synthetic, CAST(sum(n) AS BIGINT) AS count FROM rows_by "
            "GROUP BY split UNION ALL SELECT 'train', true, CAST(max(n) - min(n) AS BIGINT) "
            "FROM rows_by WHERE split = 'train' HAVING max(n) > min(n)",
        ),
        "smote_balance": with_contacts(
            *TRAIN_SIZES,
            "SELECT label, false AS is_synthetic, n AS count FROM rows_by WHERE split = 'train' "
            "UNION ALL SELECT arg_min(label, n), true, max(n) - min(n) FROM rows_by "
            "WHERE split = 'train' HAVING max(n) > min(n)",
        ),
        "index_by_dictionary": """
            WITH o AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer, o_orderpriority AS priority FROM orders),
            c AS (SELECT customer, row_number() OVER (ORDER BY count(*) DESC, customer) - 1 AS n FROM o GROUP BY customer),
            p AS (SELECT priority, row_number() OVER (ORDER BY count(*) DESC, priority) - 1 AS n FROM o GROUP BY priority)
            SELECT o_orderkey, CAST(c.n AS DOUBLE) AS customer_index, CAST(p.n AS DOUBLE) AS priority_index
            FROM o LEFT JOIN c USING (customer) LEFT JOIN p USING (priority)
        """,
        "smote_real_space": with_contacts(
            *TRAIN_SIZES,
            "SELECT arg_min(label, n) AS label, max(n) - min(n) AS count, true AS between FROM rows_by "
            "WHERE split = 'train' HAVING max(n) > min(n)",
        ),
        "smote_multiclass_balance": EMBEDDING_SIZES,
        "smote_neighbours": with_contacts(
            *POINTS, "SELECT contact_id, CAST(place AS INT) AS place, neighbour, d2 FROM nearest"
        ),
        "smote_points": with_contacts(
            *CREATED,
            "SELECT d.contact_id, d.copy, n.neighbour, d.label, " + ", ".join(
                f"round(d.vec[{i}] + d.step * (m.vec[{i}] - d.vec[{i}]), 6) AS v{i - 1}"
                for i in range(1, 9)
            ) + " FROM drawn d JOIN nearest n ON n.contact_id = d.contact_id AND n.place = d.place "
            "JOIN few m ON m.contact_id = n.neighbour",
        ),
        "forest_fit": with_contacts(
            *TRAIN_SIZES,
            "SELECT label, n AS count, true AS scores_valid FROM rows_by WHERE split = 'test'",
        ),
        "forest_reload": with_contacts(
            *CLEANED,
            f"SELECT contact_id, {SPLIT} AS split, CAST(y = 'yes' AS DOUBLE) AS label, true AS unchanged "
            "FROM cleaned",
        ),
        "score_table": with_contacts(
            *CLEANED,
            f"SELECT contact_id, {SPLIT} AS split, CAST(y = 'yes' AS DOUBLE) AS label, true AS agrees "
            "FROM cleaned",
        ),
        "grid_search": with_contacts(
            *CLEANED,
            f"SELECT CAST(t AS INT) AS num_trees, CAST(d AS INT) AS max_depth, CAST(3 AS INT) AS folds, "
            f"(SELECT CAST(2 * greatest(count(*) FILTER (y = 'yes'), count(*) FILTER (y <> 'yes')) AS BIGINT) "
            f"FROM cleaned WHERE {SPLIT} = 'train') AS rows, true AS agrees "
            "FROM (VALUES (50, 5), (50, 10), (100, 5), (100, 10)) grid(t, d)",
        ),
        "model_report": with_contacts(
            *CLEANED,
            f"SELECT {SPLIT} AS split, count(*) AS rows, true AS agrees FROM cleaned "
            f"WHERE {SPLIT} <> 'train' GROUP BY ALL",
        ),
        "feature_importance": "SELECT CAST(r AS INT) AS rank, true AS agrees FROM range(1, 16) t(r)",
        "importance_by_source": "SELECT source, true AS agrees FROM (VALUES %s) t(source)" % ", ".join(
            f"('{c}')" for c in [*CATEGORICAL, *NUMERIC]
        ),
        "decide_with_model": with_contacts(
            MARKED, FILLS,
            f"filled AS (SELECT * REPLACE ({FILL_LIST}) FROM marked)",
            "SELECT contact_id, age, job, marital, education, housing, loan, true AS agrees FROM filled",
        ),
        "decide_text_input": with_contacts(
            "SELECT contact_id, concat_ws(',', CASE WHEN contact_id % 101 = 0 THEN 'age' END, "
            "CASE WHEN contact_id % 103 = 0 THEN 'euribor3m' END) AS bad_columns, true AS agrees "
            "FROM contacts"
        ),
        "metric_auc": with_contacts(
            *LABELLED,
            "ranked AS (SELECT label, rank() OVER (ORDER BY p_yes) + (count(*) OVER "
            "(PARTITION BY p_yes) - 1) / 2 AS r FROM labelled)",
            "SELECT round((sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * "
            "(count(*) FILTER (label = 1) + 1) / 2) / (count(*) FILTER (label = 1) * "
            "count(*) FILTER (label = 0)), 9) AS auc FROM ranked",
        ),
        "metrics_unlabelled": with_contacts(
            *LABELLED,
            "known AS (SELECT label, p_yes FROM labelled WHERE contact_id % 10 NOT IN (3, 4, 5))",
            "ranked AS (SELECT label, rank() OVER (ORDER BY p_yes) + (count(*) OVER "
            "(PARTITION BY p_yes) - 1) / 2 AS r FROM known)",
            "SELECT round((sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * "
            "(count(*) FILTER (label = 1) + 1) / 2) / (count(*) FILTER (label = 1) * "
            "count(*) FILTER (label = 0)), 9) AS auc FROM ranked",
        ),
        "metrics_multiclass": with_contacts(*LABELLED, *metric_parts(), "SELECT * FROM weighted"),
        "roc_curve": with_contacts(
            *curve,
            "SELECT p_yes AS threshold, round(x, 9) AS fpr, round(y, 9) AS tpr FROM steps "
            "WHERE place = 1 OR pos_next IS NULL OR pos <> pos_next OR neg <> neg_next "
            "UNION ALL SELECT NULL, 0, 0",
        ),
        "pr_curve": with_contacts(
            *curve,
            "SELECT p_yes AS threshold, round(pr, 9) AS precision, round(y, 9) AS recall "
            "FROM steps UNION ALL SELECT NULL, 1, 0",
        ),
        "roc_auc": with_contacts(
            *curve_by,
            "SELECT split, round(sum((x - x0) * (y + y0) / 2), 9) AS roc_auc FROM steps "
            "GROUP BY split",
        ),
        "pr_auc": with_contacts(
            *curve_by,
            "SELECT split, round(sum((y - y0) * (pr + pr0) / 2), 9) AS pr_auc FROM steps "
            "GROUP BY split",
        ),
        "eval_report": with_contacts(
            *curve_by, *metric_parts("split"),
            "SELECT w.split, auc, accuracy, weighted_precision, weighted_recall, f1 "
            "FROM weighted w JOIN (SELECT split, round(sum((x - x0) * (y + y0) / 2), 9) AS auc "
            "FROM steps GROUP BY split) a ON a.split = w.split WHERE w.split <> 'train'",
        ),
        "feature_names": with_contacts(
            *CLEANED, NUMBERED, BLOCKS,
            "SELECT CAST(start + idx AS INT) AS position, c || '_' || v AS feature, c AS source "
            "FROM numbered JOIN starts USING (c) WHERE idx < labels - 1 UNION ALL "
            "SELECT CAST((SELECT slots FROM width) + i AS INT), c, c FROM (VALUES "
            + ", ".join(f"({i}, '{c}')" for i, c in enumerate(NUMERIC)) + ") t(i, c)",
        ),
        "category_domain": with_contacts(
            MARKED,
            " UNION ALL ".join(
                f"SELECT DISTINCT '{c}' AS \"column\", {q(c)} AS value FROM marked "
                f"WHERE {q(c)} IS NOT NULL" for c in CATEGORICAL
            ),
        ),
        "segment_customers": by_key(SEGMENTED, "p_yes, potential_segment", "segmented"),
        "segment_stats": with_contacts(
            *SEGMENTED, "SELECT potential_segment, count(*) AS count FROM segmented GROUP BY ALL"
        ),
        "strategy_high": audience[0],
        "strategy_high_medium": audience[1],
        "strategy_random": audience[2],
        "marketing_simulation": with_contacts(
            *SEGMENTED, f"outcome AS ({simulation})",
            'SELECT s AS "Strategy", t AS "Total Customers", w AS "Expected Conversions", '
            'CASE WHEN t = 0 THEN 0 ELSE CAST((20000 * w + t) // (2 * t) AS DOUBLE) / 10000 END '
            'AS "Conversion Rate" FROM outcome',
        ),
        "churn_score": by_key(ASSESSED, "churn_risk_score", "assessed"),
        "credit_score": by_key(ASSESSED, "credit_risk_score", "assessed"),
        "churn_level": by_key(ASSESSED, "churn_risk, churn_confidence", "assessed"),
        "credit_level": by_key(ASSESSED, "credit_risk, credit_confidence", "assessed"),
        "composite_risk": by_key(ASSESSED, "composite_risk_score, overall_risk_level", "assessed"),
        "recommended_actions": by_key(ASSESSED, "action_code, recommended_actions", "final"),
        "risk_rank": by_key(ASSESSED, "composite_risk_score, risk_priority_rank", "final"),
        "risk_summary": with_contacts(
            *ASSESSED,
            "SELECT overall_risk_level, count(*) AS customer_count, "
            "round(avg(churn_risk_score), 6) AS avg_churn_score, "
            "round(avg(credit_risk_score), 6) AS avg_credit_score, "
            "round(avg(composite_risk_score), 6) AS avg_composite_score "
            "FROM assessed GROUP BY overall_risk_level",
        ),
        "risk_counts": with_contacts(
            *ASSESSED,
            "SELECT churn_risk, credit_risk, overall_risk_level, count(*) AS count FROM assessed "
            "GROUP BY ALL",
        ),
        "risk_marginals": with_contacts(
            *ASSESSED,
            "SELECT 'churn' AS dimension, churn_risk AS level, count(*) AS count FROM assessed "
            "GROUP BY ALL UNION ALL SELECT 'credit', credit_risk, count(*) FROM assessed "
            "GROUP BY ALL UNION ALL SELECT 'overall', overall_risk_level, count(*) FROM assessed "
            "GROUP BY ALL",
        ),
        "risk_table": with_contacts(
            *ASSESSED, "SELECT * EXCLUDE (action_code, o, oi) FROM final"
        ),
        "top_at_risk": with_contacts(
            *ASSESSED,
            f"SELECT {risk_list}, risk_priority_rank FROM final WHERE risk_priority_rank <= 50",
        ),
        "top_at_risk_limit": with_contacts(
            *ASSESSED,
            f"SELECT {risk_list} FROM final ORDER BY composite_risk_score DESC, contact_id LIMIT 50",
        ),
        "score_profile": with_contacts(
            *ASSESSED,
            "SELECT count(composite_risk_score) AS count, round(avg(composite_risk_score), 6) "
            "AS mean, round(stddev_samp(composite_risk_score), 6) AS stddev, "
            "min(composite_risk_score) AS min, max(composite_risk_score) AS max FROM assessed",
        ),
        "score_histogram": histogram(bins),
        "score_histogram_overflow": histogram([*bins, (">100", "s > 100")]),
        "risk_correlation": with_contacts(*ASSESSED, correlations),
        "risk_correlation_nulls": with_contacts(
            *ASSESSED,
            "partly AS (SELECT * REPLACE (CASE WHEN contact_id % 7 <> 3 THEN pdays END AS pdays, "
            "CASE WHEN contact_id % 5 <> 1 THEN cons_conf_idx END AS cons_conf_idx) FROM assessed)",
            correlations.replace("FROM assessed", "FROM partly"),
        ),
        "typed_input": with_contacts(
            f"SELECT contact_id, {typed}, concat_ws(',', "
            "CASE WHEN contact_id % 101 = 0 THEN 'age' END, "
            "CASE WHEN contact_id % 103 = 0 THEN 'euribor3m' END) AS bad_columns FROM contacts"
        ),
        "validate_input": with_contacts(
            f"SELECT contact_id, {listed('error')} AS errors, {listed('warning')} AS warnings, "
            f"{listed('error')} = '' AS is_valid FROM contacts"
        ),
        "validation_summary": with_contacts(
            " UNION ALL ".join(
                f"SELECT '{rule}' AS rule, '{kind}' AS kind, count(*) FILTER ({cond}) AS violations "
                "FROM contacts" for rule, kind, cond in rule_list()
            )
        ),
        "rule_churn": by_key(DECIDED, "churn_risk", "decided"),
        "rule_credit": by_key(DECIDED, "credit_risk", "decided"),
        "marketing_recommendation": by_key(DECIDED, "marketing_recommendation", "decided"),
        "decide_customers": by_key(
            DECIDED,
            "CASE WHEN prediction = 1 THEN '是' ELSE '否' END AS prediction, "
            "printf('%.2f%%', p_yes * 100) AS probability, potential, churn_risk, credit_risk, "
            "marketing_recommendation, age, job, marital, education, housing, loan",
            "decided",
        ),
        "decide_stream": by_key(
            DECIDED,
            "CASE WHEN prediction = 1 THEN '是' ELSE '否' END AS prediction, "
            "printf('%.2f%%', p_yes * 100) AS probability, potential, churn_risk, credit_risk, "
            "marketing_recommendation, age, job, marital, education, housing, loan",
            "decided",
        ),
    }
