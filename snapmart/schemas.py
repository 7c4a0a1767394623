"""Columns and types of the four source tables.

Raw CSV columns are read as text, so one dirty value never changes a column's type between snapshots.
"""

# The sources' column names, in this module throughout.
ENTITY = "Customer_ID"
SNAPSHOT = "snapshot_date"

LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}

ATTRIBUTE_TYPES = {
    "Customer_ID": "string",
    "Name": "string",
    "Age": "int",
    "SSN": "string",
    "Occupation": "string",
    "snapshot_date": "date",
}

# Financial numbers that arrive as text with stray underscores, and those that arrive as plain numbers.
TEXT_NUMBERS = [
    "Annual_Income",
    "Num_of_Loan",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Outstanding_Debt",
    "Amount_invested_monthly",
    "Monthly_Balance",
]
PLAIN_NUMBERS = [
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Delay_from_due_date",
    "Num_Credit_Inquiries",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
]
FINANCIAL_NUMBERS = TEXT_NUMBERS + PLAIN_NUMBERS
FINANCIAL_TEXTS = ["Type_of_Loan", "Credit_Mix", "Credit_History_Age", "Payment_of_Min_Amount", "Payment_Behaviour"]

CLICK_FEATURES = [f"fe_{i}" for i in range(1, 21)]

# Model inputs.
CATEGORICAL_INPUTS = ["Credit_Mix", "Payment_Behaviour", "Occupation"]
NUMERIC_INPUTS = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Credit_Utilization_Ratio",
    "Credit_History_Age",
] + [f"{c}_5m_avg" for c in CLICK_FEATURES]


# Column order of the bronze tables; columns beyond these follow in name order.
RAW_COLUMNS = {
    "lms": list(LOAN_TYPES),
    "attributes": list(ATTRIBUTE_TYPES),
    "financials": [ENTITY, *FINANCIAL_NUMBERS, *FINANCIAL_TEXTS, SNAPSHOT],
    "clickstream": [ENTITY, SNAPSHOT, *CLICK_FEATURES],
}
