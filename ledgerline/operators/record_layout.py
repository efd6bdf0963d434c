"""The application record: which columns a matched application is handed on with, in which order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns of an application record, in order.
RECORD_COLUMNS = """
INVOCATIONID AIL_AvgMonthsOnBook ALL_AvgMonthsOnBook ALL_DaysSinceMRPayment ALL_MaxDelq180DaysLT24M ALL_MaxDelqEver ALL_Notices5Years
ALL_Num0Delq1Year ALL_NumEnqs180Days ALL_NumEnqs30Days ALL_NumEnqs7Days ALL_NumEnqs90Days ALL_NumPayments2Years ALL_NumPayments90Days
ALL_NumTrades180Days ALL_NumTrades30Days ALL_NumTrades90Days ALL_Perc0Delq90Days ALL_PercPayments2Years ALL_PercPayments90Days
ALL_TimeOldestTrade ALT_AirtimePurchasedAvg36M ALT_TAU APP_Account_Number1 APP_Account_Number2 APP_Account_Number3 APP_Account1 APP_Account2
APP_Account3 APP_Account4 APP_Account5 APP_Accounts APP_Activation_Date1 APP_Activation_Date2 APP_Activation_Date3 APP_Activation_Date4
APP_Activation_Date5 APP_Activation_Days1 APP_Activation_Days2 APP_Activation_Days3 APP_Activation_Days4 APP_Activation_Days5
APP_Activation_Month1 APP_Activation_Month2 APP_Activation_Month3 APP_Activation_Month4 APP_Activation_Month5 APP_Activation_Weeks1
APP_Activation_Weeks2 APP_Activation_Weeks3 APP_Activation_Weeks4 APP_Activation_Weeks5 APP_Subscriber_Number1 APP_Subscriber_Number2
APP_Subscriber_Number3 APP_Subscriber_Number4 APP_Subscriber_Number5 APP_Channel APP_Channel_CEC APP_Customer_Score APP_Customer_Score_CNT
APP_Date APP_Decision_Outcome APP_Decision_Service APP_Decision_Service_Waterfall APP_Gross_Income APP_Gross_Income_CNT APP_IDNumber
APP_Max_Product_Term APP_Max_Product_Term_CNT APP_Month APP_Predicted_Income APP_Predicted_Income_CNT APP_Record_Number APP_Risk_Grade
APP_SLIR APP_Subscription_Limit APP_Subscription_Limit_CNT APP_Subscriptions BNK_NumOpenTrades CAM_Customer_Score CAM_Customer_Score_CNT
CAM_Risk_Grade CBX_Prism_TM CBX_Prism_TM_CNT CBX_Sabre_TM CBX_Sabre_TM_CNT COM_NumOpenTrades COM_NumTrades2Years CRC_NumOpenTrades
CSN_NumTrades60Days CST_Citizen CST_CustomerAge CST_DebtReviewGranted CST_DebtReviewRequested CST_Deceased CST_Dispute CST_Emigrated
CST_Fraud CST_Sequestration DUP_Applicant DUP_Application_Sequence DUP_Calendar_Months_Skipped DUP_Days_Between_Applications
DUP_Decision_Outcome DUP_Risk_Grade EST_Customer_Score EST_Customer_Score_CNT EST_Risk_Grade Filter_Approved_No_Activations
Filter_Approved_With_Activations Filter_Arrears_Activations Filter_Arrears_No_Activations Filter_Arrears_State
Filter_Arrears_With_Activations Filter_Channel_Dealer Filter_Channel_Franchise Filter_Channel_Inbound Filter_Channel_Online
Filter_Channel_Other Filter_Channel_Outbound Filter_Channel_Store Filter_Clear_Activations Filter_Clear_State
Filter_Decision_Outcome_Approved Filter_Decision_Outcome_Arrears Filter_Decision_Outcome_Declined Filter_Decision_Outcome_Referred
Filter_Decision_Outcome_SEQ Filter_Decision_Outcome_Unknown Filter_Declined_No_Activations Filter_Declined_With_Activations
Filter_DMP_Campaign Filter_DMP_Established Filter_DMP_New Filter_DMP_Unknown Filter_Erratic_Activations Filter_Erratic_State
Filter_First_Account_Applicant Filter_Immature_Activations Filter_Immature_State Filter_New_To_Credit Filter_Other_Activations
Filter_Referred_No_Activations Filter_Referred_With_Activations Filter_Responsible_Activations Filter_Responsible_State
Filter_Risk_Grade_1 Filter_Risk_Grade_2 Filter_Risk_Grade_3 Filter_Risk_Grade_4 Filter_Risk_Grade_5 Filter_Risk_Grade_6 Filter_Risk_Grade_7
Filter_Risk_Grade_8 Filter_Risk_Grade_9 Filter_Risk_Grade_X Filter_Telesales_Inbound Filter_Telesales_Outbound Filter_Web_Service
Filter_XXXXXX_State FRN_NumOpenTrades GMP_Risk_Grade IDKey IDNumber NEW_Customer_Score NEW_Customer_Score_CNT NEW_Risk_Grade
NTC_Accept_Final_Score_V01 NTC_Accept_Final_Score_V01_CNT NTC_Accept_Risk_Score_V01 NTC_Accept_Risk_Score_V01_CNT RCG_NumTradesUtilisedLT10
UND_GMIP_Ratio UND_Risk_Grade UNN_PercTradesUtilisedLT100MR60 UNS_MaxDelq1YearLT24M
""".split()


def application_record(df: DataFrame, fill_missing: bool = True, **renamed: str) -> DataFrame:
    """Exactly the record's columns, in its order and spelling, of an application table (or of what the matching gave).

    Names are compared without case; ``renamed`` maps a record column, in lower case, to the table's own name for it.
    Columns that the table lacks are NULL (text), or raise with ``fill_missing=False``.  Other columns are left out; a
    projection, so what is left out is not read either."""
    own = {c.lower(): c for c in df.columns}
    own |= {k.lower(): v for k, v in renamed.items()}
    missing = [c for c in RECORD_COLUMNS if c.lower() not in own]
    if missing and not fill_missing:
        raise ValueError(f"the record lacks {', '.join(missing)}")
    return df.select(*[F.col(f"`{own[c.lower()]}`").alias(c) if c.lower() in own else F.lit(None).cast("string").alias(c) for c in RECORD_COLUMNS])
