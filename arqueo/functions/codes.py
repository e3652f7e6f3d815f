"""Code lists and labels of the accounting systems.

FIXED VALUES: the lists below are data of the domain (bank imputation codes,
account numbers, labels).  They must equal the values the reports were
designed with, so they are written out plainly, in their natural order.
Operators receive them as parameters; these are only the defaults.
"""

# --- fixed values: cash-flow classes of bank imputation codes -------------
CASH_FLOW_REVENUE = [
    "001", "002", "012", "022", "056", "057", "062", "141", "211", "212",
    "216", "218", "220", "222", "226", "228",
]
CASH_FLOW_OPERATING = [
    "005", "023", "024", "029", "031", "032", "033", "036", "037", "040",
    "043", "049", "059",
]
# The original list lost a comma between "142" and "143" (the two codes were
# glued into "142143"); ``cash_flow_classes(parity=True)`` reproduces that.
CASH_FLOW_WORKS = [
    "018", "019", "020", "021", "027", "035", "041", "052", "053", "065",
    "066", "072", "112", "142", "143", "162", "210", "213", "217", "219",
    "221", "225", "227",
]
CASH_FLOW_LABELS = [
    "1 - Recursos",
    "2 - Gtos. Funcionamiento",
    "3 - Inversión Obras",
]
CASH_FLOW_OTHER = "4 - OTROS"

# --- fixed values: deposits that are not revenue --------------------------
DEPOSIT_INTERNAL_TRANSFER = ["034", "004"]
DEPOSIT_TERM_FUNDS = ["214", "215"]
DEPOSIT_OTHER = ["003", "055", "005", "013"]
# The original excluded "18" although codes have three digits ("018").
DEPOSIT_NEGATIVE_CERTIFICATE = ["018"]
DEPOSIT_NEGATIVE_CERTIFICATE_PARITY = ["18"]

# --- fixed values: fund groups of bank accounts ----------------------------
FUND_GROUP_FONAVI_ACCOUNT = "10270"
FUND_GROUP_RECOVERY_ACCOUNTS = ["130832-12", "334", "Macro", "Patagonia"]
FUND_GROUP_LABELS = ("FONAVI", "RECUPEROS", "OTROS")

# --- fixed values: movements, accounts and texts --------------------------
OWN_CUIT = "30632351514"
DEPOSIT = "DEPOSITO"
PAYROLL_ACCOUNT = "130832-04"
FEES_ACCOUNT = "130832-05"
NOTARY_ACCOUNT = "130832-08"
INCOME_TAX_WORDS = ["GCIAS", "GANANCIAS"]
BANK_DEBIT_CODE = "031"
WORKS_ADVANCE_TYPE = "PA6"
WORKS_REGULARISATION_TYPE = "REG"
FLOATING_DEBT_TYPE = "RDEU"
TOP_OTHER_LABEL = "OT"


def cash_flow_classes(parity: bool = False) -> dict[str, list[str]]:
    """Ordered ``{label: codes}``; first match wins."""
    works = list(CASH_FLOW_WORKS)
    if parity:
        i = works.index("142")
        works[i : i + 2] = ["142143"]
    return dict(zip(CASH_FLOW_LABELS, [CASH_FLOW_REVENUE, CASH_FLOW_OPERATING, works]))


def non_revenue_deposits(parity: bool = False) -> list[str]:
    cert = DEPOSIT_NEGATIVE_CERTIFICATE_PARITY if parity else DEPOSIT_NEGATIVE_CERTIFICATE
    return DEPOSIT_INTERNAL_TRANSFER + DEPOSIT_TERM_FUNDS + DEPOSIT_OTHER + cert
