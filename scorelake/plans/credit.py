"""Fixed values of the credit application: field names, groups, bins and monitored features."""

# The 122 request fields in order.
FIELDS = """
SHORT_TERM_COUNT MID_TERM_COUNT LONG_TERM_COUNT SHORT_TERM_COUNT_BANK MID_TERM_COUNT_BANK
LONG_TERM_COUNT_BANK SHORT_TERM_COUNT_NON_BANK MID_TERM_COUNT_NON_BANK LONG_TERM_COUNT_NON_BANK
NUMBER_OF_LOANS NUMBER_OF_LOANS_BANK NUMBER_OF_LOANS_NON_BANK NUMBER_OF_CREDIT_CARDS
NUMBER_OF_CREDIT_CARDS_BANK NUMBER_OF_CREDIT_CARDS_NON_BANK NUMBER_OF_RELATIONSHIP
NUMBER_OF_RELATIONSHIP_BANK NUMBER_OF_RELATIONSHIP_NON_BANK NUM_NEW_LOAN_TAKEN_3M NUM_NEW_LOAN_TAKEN_6M
NUM_NEW_LOAN_TAKEN_9M NUM_NEW_LOAN_TAKEN_12M NUM_NEW_LOAN_TAKEN_BANK_3M NUM_NEW_LOAN_TAKEN_BANK_6M
NUM_NEW_LOAN_TAKEN_BANK_9M NUM_NEW_LOAN_TAKEN_BANK_12M NUM_NEW_LOAN_TAKEN_NON_BANK_3M
NUM_NEW_LOAN_TAKEN_NON_BANK_6M NUM_NEW_LOAN_TAKEN_NON_BANK_9M NUM_NEW_LOAN_TAKEN_NON_BANK_12M
OUTSTANDING_BAL_LOAN_CURRENT OUTSTANDING_BAL_LOAN_3M OUTSTANDING_BAL_LOAN_6M OUTSTANDING_BAL_LOAN_9M
OUTSTANDING_BAL_LOAN_12M OUTSTANDING_BAL_CC_3M OUTSTANDING_BAL_CC_6M OUTSTANDING_BAL_CC_9M
OUTSTANDING_BAL_CC_12M OUTSTANDING_BAL_ALL_3M OUTSTANDING_BAL_ALL_6M OUTSTANDING_BAL_ALL_9M
OUTSTANDING_BAL_ALL_12M OUTSTANDING_BAL_LOAN_3M_6M OUTSTANDING_BAL_LOAN_6M_9M OUTSTANDING_BAL_LOAN_9M_12M
OUTSTANDING_BAL_LOAN_6M_12M OUTSTANDING_BAL_LOAN_3M_12M OUTSTANDING_BAL_CC_3M_6M OUTSTANDING_BAL_CC_6M_9M
OUTSTANDING_BAL_CC_9M_12M OUTSTANDING_BAL_CC_6M_12M OUTSTANDING_BAL_CC_3M_12M OUTSTANDING_BAL_ALL_3M_6M
OUTSTANDING_BAL_ALL_6M_9M OUTSTANDING_BAL_ALL_9M_12M OUTSTANDING_BAL_ALL_6M_12M OUTSTANDING_BAL_ALL_3M_12M
INCREASING_BAL_3M_LOAN INCREASING_BAL_6M_LOAN INCREASING_BAL_3M_CC INCREASING_BAL_6M_CC INCREASING_BAL_3M_ALL
INCREASING_BAL_6M_ALL OUTSTANDING_BAL_CC_CURRENT CREDIT_CARD_MONTH_SINCE_10DPD CREDIT_CARD_MONTH_SINCE_30DPD
CREDIT_CARD_MONTH_SINCE_60DPD CREDIT_CARD_MONTH_SINCE_90DPD CREDIT_CARD_NUMBER_OF_LATE_PAYMENT ENQUIRIES_3M
ENQUIRIES_6M ENQUIRIES_9M ENQUIRIES_12M ENQUIRIES_FROM_BANK_3M ENQUIRIES_FROM_NON_BANK_3M
ENQUIRIES_FOR_LOAN_3M ENQUIRIES_FOR_CC_3M ENQUIRIES_FROM_BANK_FOR_LOAN_3M ENQUIRIES_FROM_NON_BANK_FOR_LOAN_3M
ENQUIRIES_FROM_BANK_FOR_CC_3M ENQUIRIES_FROM_NON_BANK_FOR_CC_3M ENQUIRIES_FROM_BANK_6M
ENQUIRIES_FROM_NON_BANK_6M ENQUIRIES_FOR_LOAN_6M ENQUIRIES_FOR_CC_6M ENQUIRIES_FROM_BANK_FOR_LOAN_6M
ENQUIRIES_FROM_NON_BANK_FOR_LOAN_6M ENQUIRIES_FROM_BANK_FOR_CC_6M ENQUIRIES_FROM_NON_BANK_FOR_CC_6M
ENQUIRIES_FROM_BANK_9M ENQUIRIES_FROM_NON_BANK_9M ENQUIRIES_FOR_LOAN_9M ENQUIRIES_FOR_CC_9M
ENQUIRIES_FROM_BANK_FOR_LOAN_9M ENQUIRIES_FROM_NON_BANK_FOR_LOAN_9M ENQUIRIES_FROM_BANK_FOR_CC_9M
ENQUIRIES_FROM_NON_BANK_FOR_CC_9M ENQUIRIES_FROM_BANK_12M ENQUIRIES_FROM_NON_BANK_12M ENQUIRIES_FOR_LOAN_12M
ENQUIRIES_FOR_CC_12M ENQUIRIES_FROM_BANK_FOR_LOAN_12M ENQUIRIES_FROM_NON_BANK_FOR_LOAN_12M
ENQUIRIES_FROM_BANK_FOR_CC_12M ENQUIRIES_FROM_NON_BANK_FOR_CC_12M ENQUIRIES_3M_6M ENQUIRIES_6M_9M
ENQUIRIES_9M_12M ENQUIRIES_6M_12M ENQUIRIES_3M_12M ENQUIRIES_FROM_BANK_3M_6M ENQUIRIES_FROM_BANK_6M_9M
ENQUIRIES_FROM_BANK_9M_12M ENQUIRIES_FROM_BANK_6M_12M ENQUIRIES_FROM_BANK_3M_12M
ENQUIRIES_FROM_NON_BANK_3M_6M ENQUIRIES_FROM_NON_BANK_6M_9M ENQUIRIES_FROM_NON_BANK_9M_12M
ENQUIRIES_FROM_NON_BANK_6M_12M ENQUIRIES_FROM_NON_BANK_3M_12M OUTSTANDING_BAL_ALL_CURRENT
""".split()

# Correlated groups are recognised by name; the key is the prefix of the component columns.
GROUPS = {
    "OUTSTANDING_BAL": [c for c in FIELDS if c.startswith(("OUTSTANDING_BAL_", "INCREASING_BAL_"))],
    "NUM_NEW_LOAN_TAKEN": [c for c in FIELDS if c.startswith("NUM_NEW_LOAN_TAKEN_")],
    "ENQUIRIES": [c for c in FIELDS if c.startswith("ENQUIRIES_")],
}
COMPONENTS = {"OUTSTANDING_BAL": 5, "NUM_NEW_LOAN_TAKEN": 3, "ENQUIRIES": 5}
SELECTED_FEATURES = 22
NEIGHBOURS = 20

# Scorecard features, their bin counts and how their edges are found.
SCORECARD = {
    "NUMBER_OF_LOANS": (5, "frequency"),
    "NUMBER_OF_CREDIT_CARDS": (5, "entropy"),
    "SHORT_TERM_COUNT_BANK": (3, "entropy"),
    "SHORT_TERM_COUNT_NON_BANK": (3, "entropy"),
    "NUMBER_OF_RELATIONSHIP_BANK": (4, "frequency"),
    "NUMBER_OF_RELATIONSHIP_NON_BANK": (4, "frequency"),
    "NUMBER_OF_LOANS_NON_BANK": (3, "entropy"),
    "NUMBER_OF_CREDIT_CARDS_BANK": (3, "entropy"),
    "NUM_NEW_LOAN_TAKEN_PCA_1": (8, "frequency"),
    "NUM_NEW_LOAN_TAKEN_PCA_2": (8, "frequency"),
    "OUTSTANDING_BAL_PCA_2": (8, "frequency"),
    "OUTSTANDING_BAL_PCA_3": (8, "frequency"),
    "OUTSTANDING_BAL_PCA_5": (8, "frequency"),
    "ENQUIRIES_PCA_1": (8, "frequency"),
    "ENQUIRIES_PCA_2": (8, "frequency"),
    "ENQUIRIES_PCA_3": (8, "frequency"),
    "ENQUIRIES_PCA_4": (8, "frequency"),
    "ENQUIRIES_PCA_5": (8, "frequency"),
}
BINS = {feature: bins for feature, (bins, _) in SCORECARD.items()}
EQUAL_FREQUENCY = [feature for feature, (_, edges) in SCORECARD.items() if edges == "frequency"]

# Features watched for drift by the performance monitor.
MONITORED = [
    "NUMBER_OF_LOANS",
    "NUMBER_OF_CREDIT_CARDS",
    "NUMBER_OF_RELATIONSHIP",
    "SHORT_TERM_COUNT_BANK",
    "SHORT_TERM_COUNT_NON_BANK",
    "ENQUIRIES_3M",
    "ENQUIRIES_6M",
    "NUM_NEW_LOAN_TAKEN_3M",
    "NUM_NEW_LOAN_TAKEN_6M",
    "OUTSTANDING_BAL_LOAN_CURRENT",
    "OUTSTANDING_BAL_ALL_CURRENT",
    "CREDIT_CARD_MONTH_SINCE_30DPD",
    "CREDIT_CARD_NUMBER_OF_LATE_PAYMENT",
]
# Features of the column drift report.
REPORTED = [
    "ENQUIRIES_3M",
    "ENQUIRIES_6M",
    "NUM_NEW_LOAN_TAKEN_3M",
    "NUM_NEW_LOAN_TAKEN_6M",
    "OUTSTANDING_BAL_LOAN_CURRENT",
    "OUTSTANDING_BAL_ALL_CURRENT",
    "NUMBER_OF_LOANS",
    "NUMBER_OF_CREDIT_CARDS",
    "CREDIT_CARD_MONTH_SINCE_30DPD",
    "CREDIT_CARD_NUMBER_OF_LATE_PAYMENT",
]

# Histogram bucket bounds (seconds, probability, share of missing features).
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]
PROBABILITY_BOUNDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
MISSING_BOUNDS = [0.0, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9, 1.0]

# Alert rules as (rule, measure, of what, window in minutes, threshold, hold in seconds), evaluated each minute.
ALERT_STEP_S = 60
ALERT_RULES = [
    ("HighErrorRate", "rate", "status = 500", 5, 0.01, 120),
    ("HighLatencyP95", "quantile", ("latency", LATENCY_BOUNDS, 0.95), 5, 0.5, 300),
    ("ModelReloadFailing", "increase", "reload_failed", 15, 0.0, 60),
    ("HighFeatureMissingRate", "quantile", ("missing_rate", MISSING_BOUNDS, 0.9), 10, 0.7, 300),
]
