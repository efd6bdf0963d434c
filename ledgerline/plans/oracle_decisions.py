"""Tables of the decision and scorecard oracles, apart from the operators' registries.

All of these are fixed values, in their order of evaluation.  A wrong cut-off, word, order or label on either side makes a query
and its oracle differ.
"""

from __future__ import annotations

from typing import NamedTuple


class Bins(NamedTuple):
    """Points of a number: of NULL, by the first bin that holds ((operator, bound, points)), of the rest."""

    name: str
    null: int
    bins: tuple
    rest: int


class Codes(NamedTuple):
    """Points of a text code: what NULL is (the blank code, 0 points, no score at all), of the blank code, of groups of codes."""

    name: str
    null: str
    blank: int
    groups: tuple


class Step(NamedTuple):
    """A segment of the decision services: its code as written, flag, claimed states (None: by trade history), channel, whether
    the debt-review and income rules apply, own rules, grade text, cut-offs, score, states of the matrix (None: the claimed
    ones) and grades of the matrix."""

    code: str
    flag: str
    states: tuple | None
    channel: str | None
    debt_review: bool
    income: bool
    checks: tuple
    approves: str
    prism_cuts: tuple
    score: str
    score_cuts: tuple
    matrix_states: tuple | None
    grades: tuple


SCORECARDS = {
    "cam": (  # campaign customers
        Bins("num0delq1y", 73, (("<", -6, 0), ("<", 0, 53), ("<", 10, 53), ("<", 20, 59), ("<", 30, 67), ("<", 40, 73), ("<", 65, 83),
             ("<", 100, 100)), 112),
        Bins("percpay2y", 73, (("<", -6, 0), ("<", 0, 51), ("<", 30, 51), ("<", 55, 58), ("<", 65, 64), ("<", 75, 68), ("<", 85, 74)), 80),
        Codes("maxdelq180d", "void", 73, ((("!", "$", "-", "="), 0), ((".", "-1", "?", "@"), 72), (("0",), 76), (("1",), 65), (("2",), 58),
              (("3", "4", "5"), 54), (("6", "7", "8"), 54), (("9", "I", "J", "L", "W"), 54))),
        Bins("avgmob", 73, (("<", -6, 0), ("<", 0, 68), ("<", 6, 65), ("<", 18, 72), ("<", 60, 79)), 86),
        Bins("percutil", 73, (("<", -6, 0), ("<", 0, 65), ("<", 55, 69)), 74),
        Codes("maxdelqever", "void", 73, ((("!", "$", "-", "="), 0), ((".", "-1", "?", "@"), 73), (("0", "1", "2"), 73), (("3", "4", "5"), 73),
              (("6", "7", "8"), 70), (("9", "I", "J", "L", "W"), 66))),
        Bins("perc0delq90", 73, (("<", -6, 0), ("<", 0, 64), ("<", 55, 64), ("<", 70, 67), ("<", 85, 70)), 73),
        Bins("trades2y", 73, (("<", -6, 0), ("<", 0, 115), ("<", 1, 115), ("<", 2, 82)), 63),
    ),
    "est": (  # established customers
        Bins("perc0delq90", 73, (("<", -6, 0), ("<", 0, 52), ("<", 50, 52), ("<", 70, 60), ("<", 80, 67), ("<", 85, 70), ("<", 90, 75),
             ("<", 95, 80)), 91),
        Bins("trades180", 73, (("<", -6, 0), ("<", 0, 86), ("<", 1, 86), ("<", 2, 80), ("<", 3, 70), ("<", 4, 61), ("<", 5, 53)), 44),
        Bins("num0delq1y", 73, (("<=", -6, 0), ("<", 0, 54), ("<", 20, 54), ("<", 35, 65), ("<", 45, 71), ("<", 65, 78), ("<", 80, 84)), 93),
        Codes("maxdelq1y", "blank", 73, ((("!", "$", "-", "="), 0), ((".", "-1", "?", "@"), 89), (("0",), 85), (("1", "2"), 67),
              (("3", "4", "5"), 58), (("6", "7", "8"), 58), (("9", "I", "J", "L", "W"), 58))),
        Bins("percpay2y", 73, (("<", -6, 0), ("<", 0, 69), ("<", 65, 69), ("<", 70, 72), ("<", 75, 74), ("<", 80, 76), ("<", 85, 78), ("<", 90, 81),
             ("<", 95, 86)), 88),
        Bins("util_lt10", 73, (("<", -6, 0), ("<", 0, 73), ("<", 1, 75), ("<", 2, 87)), 96),
        Bins("percutil", 73, (("<", -6, 0), ("<", 0, 77), ("<", 2, 77), ("<", 30, 73), ("<", 50, 75), ("<", 65, 78), ("<", 80, 79)), 81),
        Bins("avgmob", 73, (("<", -6, 0), ("<", 0, 52), ("<", 18, 52), ("<", 24, 59), ("<", 30, 62), ("<", 36, 67), ("<", 42, 71), ("<", 54, 75),
             ("<", 72, 83), ("<", 96, 90)), 99),
    ),
    "new": (  # new customers
        Bins("num0delq1y", 73, (("<", -6, 0), ("<", 0, 54), ("<", 5, 54), ("<", 10, 63), ("<", 20, 67), ("<", 30, 73), ("<", 35, 76), ("<", 45, 80),
             ("<", 55, 84), ("<", 70, 89), ("<", 100, 96)), 103),
        Bins("percpay2y", 73, (("<", -6, 0), ("<", 0, 55), ("<", 30, 55), ("<", 40, 59), ("<", 50, 62), ("<", 60, 66), ("<", 65, 69), ("<", 70, 72),
             ("<", 75, 75), ("<", 80, 77), ("<", 85, 79), ("<", 90, 84)), 85),
        Bins("avgmob", 73, (("<=", -6, 0), ("<", 0, 52), ("<", 1, 52), ("<", 6, 63), ("<", 12, 66), ("<", 24, 68), ("<", 36, 71), ("<", 42, 73),
             ("<", 48, 75), ("<", 54, 78), ("<", 60, 79), ("<", 66, 82), ("<", 84, 86), ("<", 120, 94)), 107),
        Codes("maxdelq180d", "zero", 73, ((("!", "$", "-", "="), 0), ((".", "-1", "?", "@"), 76), (("0",), 76), (("1",), 70), (("2",), 66),
              (("3", "4", "5"), 61), (("6", "7", "8"), 56), (("9", "I", "J", "L", "W"), 49))),
        Bins("trades180", 73, (("<", -6, 0), ("<", 0, 77), ("<", 1, 77), ("<", 3, 73), ("<", 5, 62)), 50),
        Bins("util_lt10", 73, (("<", -6, 0), ("<", 0, 63), ("<", 1, 72), ("<", 2, 83)), 95),
        Bins("perc0delq90", 73, (("<", -6, 0), ("<", 0, 63), ("<", 5, 63), ("<", 30, 64), ("<", 55, 67), ("<", 70, 70), ("<", 80, 72), ("<", 85, 73),
             ("<", 90, 75)), 76),
        Codes("maxdelqever", "zero", 73, ((("!", "$", "-", "="), 0), ((".", "-1", "?", "@"), 77), (("0", "1"), 77), (("2",), 75), (("3",), 74),
              (("4",), 72), (("5", "6", "7", "8"), 70), (("9", "I", "J", "L", "W"), 66))),
    ),
}

SEGMENTS = (
    Step("NTC", "filter_new_to_credit", None, None, True, True,
         (("ntc_accept_final_score_v01", "null", None, "C01 Accept Final Score V01 is None"),
          ("ntc_accept_final_score_v01", "<", 580, "C01 Accept Final Score V01 < 580"),
          ("ntc_accept_risk_score_v01", "null", None, "C01 Accept Risk Score V01 is None"),
          ("ntc_accept_risk_score_v01", "<", 580, "C01 Accept Risk Score V01 < 580")),
         "RG9", (999, 999, 999, 999, 999, 999), "new_customer_score", (999, 999, 999, 999, 999, 999), None,
         ()),
    Step("TSO", "filter_telesales_outbound", ("", "IMM MOB 00-05"), "filter_channel_outbound", True, True,
         (("cbx_prism_tm", "<", 580, "C01 Prism TM < 580"), ("new_customer_score", "<", 555, "C01 New Customer Score < 555"),
          ("all_perc0delq90days", "<", 60, "G02 UTD bureau trades last 90 days < 60%"),
          ("all_numpayments90days", "==", 0, "G04 Number bureau payments last 90 days = 0")),
         "RG9", (580, 999, 999, 999, 999, 999), "new_customer_score", (555, 999, 999, 999, 999, 999), None,
         (("580x555", "9"), ("580x585", "8"), ("640x555", "8"), ("640x585", "8"))),
    Step("TSI", "filter_telesales_inbound", ("", "IMM MOB 00-05"), "filter_channel_inbound", True, True,
         (("cbx_prism_tm", "<", 580, "C01 Prism TM < 580"), ("new_customer_score", "<", 555, "C01 New Customer Score < 555"),
          ("all_perc0delq90days", "<", 40, "G02 UTD bureau trades last 90 days < 40%"),
          ("all_numpayments90days", "==", 0, "G04 Number bureau payments last 90 days = 0")),
         "RG8", (580, 999, 999, 999, 999, 999), "new_customer_score", (555, 999, 999, 999, 999, 999), None,
         (("580x555", "9"), ("580x585", "8"), ("600x555", "8"), ("600x585", "8"))),
    Step("WWW", "filter_web_service", ("", "IMM MOB 00-05"), "filter_channel_online", True, True,
         (("cbx_prism_tm", "<", 580, "C01 Prism TM < 580"), ("new_customer_score", "<", 555, "C01 New Customer Score < 555"),
          ("all_perc0delq90days", "<", 20, "G02 UTD bureau trades last 90 days < 20%"),
          ("all_numpayments90days", "==", 0, "G04 Number bureau payments last 90 days = 0")),
         "RG7", (580, 999, 999, 999, 999, 999), "new_customer_score", (555, 999, 999, 999, 999, 999), None,
         ()),
    Step("FAA", "filter_first_account_applicant", ("",), None, True, True,
         (("cbx_prism_tm", "<", 580, "C01 Prism TM < 580"), ("new_customer_score", "<", 555, "C01 New Customer Score < 555"),
          ("all_perc0delq90days", "<", 20, "G02 UTD bureau trades last 90 days < 20%"),
          ("all_numpayments90days", "==", 0, "G04 Number bureau payments last 90 days = 0")),
         "RG7", (580, 625, 655, 999, 999, 999), "new_customer_score", (555, 590, 605, 999, 999, 999), None,
         (("580x555", "9"), ("580x590", "7"), ("580x605", "6"), ("625x555", "7"), ("625x590", "6"), ("625x605", "5"), ("655x555", "5"),
          ("655x590", "5"), ("655x605", "4"))),
    Step("IMM", "filter_immature_state", ("IMM MOB 00-05",), None, True, True,
         (("cbx_prism_tm", "<", 580, "C01 Prism TM < 580"), ("new_customer_score", "<", 555, "C01 New Customer Score < 555"),
          ("all_perc0delq90days", "<", 20, "G02 UTD bureau trades last 90 days < 20%"),
          ("all_numpayments90days", "==", 0, "G04 Number bureau payments last 90 days = 0")),
         "RG7", (580, 640, 999, 999, 999, 999), "new_customer_score", (555, 590, 615, 999, 999, 999), ("",),
         (("580x555", "8"), ("580x590", "6"), ("580x615", "6"), ("640x555", "7"), ("640x590", "5"), ("640x615", "4"))),
    Step("PUP", "filter_xxxxxx_state", ("PUP Paid-Up",), None, True, False,
         (("cbx_prism_tm", "<", 570, "C01 Prism TM < 570"), ("est_customer_score", "<", 540, "C01 Established Customer Score < 540"),
          ("all_perc0delq90days", "<", 10, "G02 UTD bureau trades last 90 days < 10%"),
          ("all_numpayments90days", "==", 0, "G04 Number bureau payments last 90 days = 0")),
         "RG7", (570, 999, 999, 999, 999, 999), "est_customer_score", (540, 615, 630, 999, 999, 999), None,
         (("570x540", "8"), ("570x615", "7"), ("570x630", "6"))),
    Step("PUP", "filter_xxxxxx_state", ("PUP Paid-Up",), None, True, False,
         (("cbx_prism_tm", "<", 570, "C01 Prism TM < 570"), ("est_customer_score", "<", 540, "C01 Established Customer Score < 540"),
          ("all_perc0delq90days", "<", 10, "G02 UTD bureau trades last 90 days < 10%"),
          ("all_numpayments90days", "==", 0, "G04 Number bureau payments last 90 days = 0")),
         "RG3", (570, 630, 999, 999, 999, 999), "est_customer_score", (540, 605, 999, 999, 999, 999), ("CRD Credit Balance",),
         (("570x540", "5"), ("570x605", "4"), ("630x540", "5"), ("630x605", "3"))),
    Step("CRD", "filter_clear_state", ("CLR Clear",), None, False, False,
         (("est_customer_score", "<", 540, "C01 Established Customer Score < 540"),),
         "RG2", (100, 625, 635, 665, 999, 999), "est_customer_score", (540, 600, 645, 999, 999, 999), None,
         (("100x540", "5"), ("100x600", "4"), ("100x645", "3"), ("625x540", "5"), ("625x600", "3"), ("625x645", "3"), ("635x540", "5"),
          ("635x600", "3"), ("635x645", "2"), ("665x540", "3"), ("665x600", "2"), ("665x645", "1"))),
    Step("RES", "filter_responsible_state", ("RES Responsible",), None, False, False,
         (("est_customer_score", "<", 540, "C01 Established Customer Score < 540"),),
         "RG5", (100, 640, 670, 999, 999, 999), "est_customer_score", (540, 570, 610, 640, 999, 999), None,
         (("100x540", "8"), ("100x570", "7"), ("100x610", "6"), ("100x640", "5"), ("640x540", "7"), ("640x570", "6"), ("640x610", "5"),
          ("640x640", "4"), ("670x540", "6"), ("670x570", "5"), ("670x610", "4"), ("670x640", "3"))),
    Step("ERR", "filter_erratic_state", ("ERR Erratic",), None, False, False,
         (("cbx_prism_tm", "<", 580, "C01 Prism TM < 580"), ("est_customer_score", "<", 555, "C01 Established Customer Score < 555")),
         "RG7", (580, 640, 670, 999, 999, 999), "est_customer_score", (555, 605, 625, 635, 645, 999), None,
         (("580x555", "8"), ("580x605", "7"), ("580x625", "7"), ("580x635", "6"), ("580x645", "6"), ("640x555", "7"), ("640x605", "7"),
          ("640x625", "6"), ("640x635", "6"), ("640x645", "5"), ("670x555", "6"), ("670x605", "5"), ("670x625", "5"), ("670x635", "5"),
          ("670x645", "4"))),
    Step("ARR", "filter_arrears_state", ("EXT Extended", "DIS Distressed", "DBT Doubtful Debt"), None, True, False,
         (("cbx_prism_tm", "<", 615, "C01 Prism TM < 615"), ("est_customer_score", "<", 590, "C01 Established Customer Score < 590"),
          ("all_perc0delq90days", "<", 50, "G02 UTD bureau trades last 90 days < 50%")),
         "RG8", (615, 690, 999, 999, 999, 999), "est_customer_score", (590, 655, 999, 999, 999, 999), None,
         (("615x590", "8"), ("615x655", "7"), ("690x590", "7"), ("690x655", "6"))),
)

# what is different in the segments as evidently intended: (place, code, states, states of the matrix)
INTENDED = (
    (5, "IMM", ("IMM MOB 00-05",), None),
    (7, "CRD", ("CRD Credit Balance",), None),
    (8, "CLR", ("CLR Clear",), None),
)
# the place of the segment that, as delivered, is applied to other states than its matrix is computed for
CROSSED = 5
# the place of the segment whose rules also fail on missing values
STRICT = 0

REPORT_MEASURES = (
    "freq", "app_subscriptions", "app_accounts", "filter_decision_outcome_approved", "filter_decision_outcome_referred",
    "filter_decision_outcome_declined", "filter_approved_with_activations", "filter_referred_with_activations", "filter_declined_with_activations",
    "filter_approved_no_activations", "filter_referred_no_activations", "filter_declined_no_activations", "badrate1m", "badrate3m", "badrate6m",
    "badrate9m", "badrate12m", "goods1", "bads1", "goods3", "bads3", "goods6", "bads6", "goods9", "bads9", "goods12", "bads12", "app_customer_score",
    "app_customer_score_cnt", "new_customer_score", "new_customer_score_cnt", "cam_customer_score", "cam_customer_score_cnt", "est_customer_score",
    "est_customer_score_cnt", "cbx_prism_tm", "cbx_prism_tm_cnt", "ntc_accept_risk_score_v01", "ntc_accept_risk_score_v01_cnt",
    "ntc_accept_final_score_v01", "ntc_accept_final_score_v01_cnt", "app_subscription_limit", "app_subscription_limit_cnt", "app_gross_income",
    "app_gross_income_cnt", "app_predicted_income", "app_predicted_income_cnt",
)
SCORE_AVERAGES = (
    "app_customer_score", "new_customer_score", "cam_customer_score", "est_customer_score", "cbx_prism_tm", "ntc_accept_risk_score_v01",
    "ntc_accept_final_score_v01", "app_subscription_limit", "app_gross_income", "app_predicted_income",
)
OUTPUT_FLAGS = (
    "filter_new_to_credit", "filter_telesales_outbound", "filter_telesales_inbound", "filter_web_service", "filter_first_account_applicant",
    "filter_immature_state", "filter_xxxxxx_state", "filter_clear_state", "filter_responsible_state", "filter_erratic_state", "filter_arrears_state",
)
ACTIVATION_FLAGS = (
    "filter_immature_activations", "filter_clear_activations", "filter_responsible_activations", "filter_erratic_activations",
    "filter_arrears_activations", "filter_other_activations",
)
DECISION_SERVICES = (
    ("NEW TO CREDIT", "filter_new_to_credit"), ("FIRST ACCOUNT APPLICANT", "filter_first_account_applicant"), ("WEB SERVICE", "filter_web_service"),
    ("TELESALES INBOUND", "filter_telesales_inbound"), ("TELESALES OUTBOUND", "filter_telesales_outbound"),
    ("IMMATURE CUSTOMER STATE", "filter_immature_state"), ("CLEAR CUSTOMER STATE", "filter_clear_state"),
    ("RESPONSIBLE CUSTOMER STATE", "filter_responsible_state"), ("ERRATIC CUSTOMER STATE", "filter_erratic_state"),
    ("ARREARS CUSTOMER STATE", "filter_arrears_state"), ("XXXXXXX CUSTOMER STATE", "filter_xxxxxx_state"), ("CAMPAIGN", "filter_dmp_campaign"),
    ("NEW", "filter_dmp_new"), ("ESTABLISHED", "filter_dmp_established"),
)
