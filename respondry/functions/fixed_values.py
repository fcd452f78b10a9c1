"""Fixed values.

Every literal in this file has to equal the behaviour being reproduced: column names and their
order, allowed categories, score thresholds and points, level names and message texts.
Nothing here is logic; operators import these values or take them as default arguments.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- contact table -------------------------------------------------------------------------

CATEGORICAL_COLUMNS = (
    "job", "marital", "education", "default", "housing", "loan",
    "contact", "month", "day_of_week", "poutcome",
)
NUMERIC_COLUMNS = (
    "age", "campaign", "pdays", "previous",
    "emp_var_rate", "cons_price_idx", "cons_conf_idx", "euribor3m", "nr_employed",
)
CONTACT_COLUMNS = (
    "age", "job", "marital", "education", "default", "housing", "loan", "contact", "month",
    "day_of_week", "duration", "campaign", "pdays", "previous", "poutcome", "emp_var_rate",
    "cons_price_idx", "cons_conf_idx", "euribor3m", "nr_employed", "y",
)
INTEGER_COLUMNS = ("age", "duration", "campaign", "pdays", "previous")
MACRO_COLUMNS = ("emp_var_rate", "cons_price_idx", "cons_conf_idx", "euribor3m", "nr_employed")
DOTTED_NAMES = ("emp.var.rate", "cons.price.idx", "cons.conf.idx", "nr.employed")
LABEL_COLUMN = "y"
POSITIVE_LABEL = "yes"
DROPPED_COLUMNS = ("duration",)
MISSING_MARKER = "unknown"
AGE_RANGE = (18, 100)

# --- splits, sampling, model search --------------------------------------------------------

SEED = 42
SPLIT_FRACTIONS = (("train", 0.70), ("val", 0.15), ("test", 0.15))
SAMPLE_FRACTION = 0.30
OVERSAMPLE_NEIGHBOURS = 5
GRID_NUM_TREES = (50, 100)
GRID_MAX_DEPTH = (5, 10)
FOLDS = 3
TOP_FEATURES = 15

# --- segments and campaign strategies ------------------------------------------------------

HIGH_POTENTIAL = "High Potential"
MEDIUM_POTENTIAL = "Medium Potential"
LOW_POTENTIAL = "Low Potential"
HIGH_CUT = 0.8
MEDIUM_CUT = 0.5

STRATEGY_HIGH = "High Potential Only"
STRATEGY_HIGH_MEDIUM = "High + Medium Potential"
STRATEGY_RANDOM = "Random Sampling (30%)"
STRATEGIES = (STRATEGY_HIGH, STRATEGY_HIGH_MEDIUM, STRATEGY_RANDOM)

# --- risk ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Term:
    """``points`` when ``column op threshold`` holds, ``otherwise`` when not (or null)."""

    column: str
    op: str
    threshold: float
    points: int
    otherwise: int


CHURN_TERMS = {
    LOW_POTENTIAL: (
        Term("pdays", ">", 90, 40, 20),
        Term("campaign", ">", 5, 30, 15),
        Term("previous", "<", 2, 30, 10),
    ),
    MEDIUM_POTENTIAL: (
        Term("pdays", ">", 60, 35, 15),
        Term("campaign", ">", 3, 25, 10),
        Term("poutcome_index", "<", 0.5, 25, 5),
    ),
    HIGH_POTENTIAL: (
        Term("pdays", ">", 30, 25, 10),
        Term("previous", "<", 1, 15, 5),
    ),
}
CHURN_OTHER_SEGMENT = 10

# below the threshold -> points; first match wins
CREDIT_BASE = ((-40, 50), (-20, 30))
CREDIT_BASE_OTHERWISE = 10
CREDIT_FLAGS = (("default", 50), ("loan", 15), ("housing", 15))

# at or above the threshold -> name; first match wins, last name otherwise
CHURN_LEVELS = ((70, "High Churn Risk"), (40, "Medium Churn Risk"), (None, "Low Churn Risk"))
CHURN_CONFIDENCE = ((85, "Very High"), (70, "High"), (55, "Medium"), (40, "Low"), (None, "Very Low"))
CREDIT_LEVELS = ((60, "High Credit Risk"), (30, "Medium Credit Risk"), (None, "Low Credit Risk"))
CREDIT_CONFIDENCE = ((75, "Very High"), (60, "High"), (45, "Medium"), (30, "Low"), (None, "Very Low"))
OVERALL_LEVELS = ((65, "High Risk"), (35, "Medium Risk"), (None, "Low Risk"))

# composite = (6 * churn + 4 * credit) / 10
CHURN_WEIGHT_TENTHS = 6
CREDIT_WEIGHT_TENTHS = 4

ACTION_TEXTS = {
    "urgent": "紧急：安排立即个人联系。提供客户保留计划和财务咨询。",
    "high_priority": "高优先级：启动客户保留活动。考虑基于以往互动的个性化优惠。",
    "attention": "需要关注：密切监控账户。考虑主动信贷咨询或重组选项。",
    "moderate": "中等关注：纳入下次外联活动。评估产品适合度和满意度。",
    "routine": "常规：通过标准营销渠道保持定期互动。",
}

# --- dashboard -----------------------------------------------------------------------------

PRIORITY_LIST_SIZE = 50
SCORE_BINS = ((0, 20), (20, 40), (40, 60), (60, 80), (80, 100))
RISK_INDICATORS = (
    "churn_risk_score", "credit_risk_score", "cons_conf_idx", "pdays", "campaign", "previous",
)

# --- customer decisions --------------------------------------------------------------------

# churn rule cut-offs on days since the last contact and on contacts in this campaign
RULE_LOW_PDAYS, RULE_LOW_CAMPAIGN, RULE_LOW_PREVIOUS = 90, 5, 2
RULE_MEDIUM_PDAYS, RULE_MEDIUM_CAMPAIGN = 60, 3
RULE_HIGH_PDAYS = 30
RULE_CONFIDENCE_HIGH, RULE_CONFIDENCE_MEDIUM = -40, -20

RECOMMENDATION_BASE = {
    HIGH_POTENTIAL: "高级营销活动：直接个人电话联系，提供优质的定期存款产品，降低利率门槛",
    MEDIUM_POTENTIAL: "标准营销活动：先发送邮件，然后电话跟进，提供常规定期存款产品",
    LOW_POTENTIAL: "基础营销活动：群发邮件提供基本定期存款信息，定期更新",
}
RECOMMENDATION_CHURN = {
    "High Churn Risk": "。紧急提示：增加客户保留激励措施，如专属利率或增值服务",
    "Medium Churn Risk": "。建议：包含忠诚度奖励，如期限灵活性或特殊优惠",
}
RECOMMENDATION_CREDIT = {"High Credit Risk": "。风险提示：推荐保守型金融产品，降低风险敞口"}
WORD_YES = "是"
WORD_NO = "否"
SUMMARY_COLUMNS = ("age", "job", "marital", "education", "housing", "loan")

# --- input validation ----------------------------------------------------------------------

ALLOWED_VALUES = {
    "job": ("admin.", "blue-collar", "entrepreneur", "housemaid", "management", "retired",
            "self-employed", "services", "student", "technician", "unemployed"),
    "marital": ("married", "single", "divorced"),
    "education": ("basic.4y", "basic.6y", "basic.9y", "high.school", "illiterate",
                  "professional.course", "university.degree"),
    "default": ("no", "yes"),
    "housing": ("no", "yes"),
    "loan": ("no", "yes"),
    "contact": ("cellular", "telephone"),
    "month": ("jan", "feb", "mar", "apr", "may", "jun",
              "jul", "aug", "sep", "oct", "nov", "dec"),
    "day_of_week": ("mon", "tue", "wed", "thu", "fri"),
    "poutcome": ("failure", "nonexistent", "success"),
}
HARD_LIMITS = {"age": (18, 95), "campaign": (1, 50), "pdays": (-1, 999), "previous": (0, 50)}
RECOMMENDED_LIMITS = {
    "age": (18, 90),
    "campaign": (1, 20),
    "previous": (0, 10),
    "emp_var_rate": (-3.4, 1.4),
    "cons_price_idx": (92.2, 94.8),
    "cons_conf_idx": (-50.8, -26.9),
    "euribor3m": (0.6, 5.0),
    "nr_employed": (4963.0, 5228.0),
}
