"""Lookup values the cleaning rules and questions depend on.

FIXED VALUES -- these must equal the values of the analytics project this
engine reproduces, so that cleaned tables and answers agree.  They are
stated plainly, in their natural order, and used as small literal maps
(``create_map``) or tiny broadcast tables whose size is fixed by this file.
"""

from __future__ import annotations

# ---------------------------------------------------------------- FIXED VALUES
# Missing-value tokens (after trim + lower-case).
NULL_TOKENS = ["", "nan", "none", "null", "na", "n/a", "nat"]
# Price text that means "no price".
PRICE_TEXT_TOKENS = ["price on request", "por", "tbd", "na", "n/a"]

# City aliases (after trim, whitespace collapse, case fold) -> canonical city.
CITY_ALIASES = {
    "mumbai": "Mumbai",
    "bombay": "Mumbai",
    "mumba": "Mumbai",
    "delhi": "Delhi",
    "new delhi": "Delhi",
    "delhi ncr": "Delhi",
    "bangalore": "Bangalore",
    "bengaluru": "Bangalore",
    "banglore": "Bangalore",
    "bengalore": "Bangalore",
    "kolkata": "Kolkata",
    "calcutta": "Kolkata",
    "chennai": "Chennai",
    "madras": "Chennai",
    "chenai": "Chennai",
    "pune": "Pune",
    "ahmedabad": "Ahmedabad",
    "hyderabad": "Hyderabad",
    "jaipur": "Jaipur",
    "surat": "Surat",
    "nagpur": "Nagpur",
    "kanpur": "Kanpur",
    "lucknow": "Lucknow",
    "indore": "Indore",
    "coimbatore": "Coimbatore",
    "kochi": "Kochi",
    "visakhapatnam": "Visakhapatnam",
    "patna": "Patna",
    "vadodara": "Vadodara",
    "bhubaneswar": "Bhubaneswar",
    "chandigarh": "Chandigarh",
    "ludhiana": "Ludhiana",
    "saharanpur": "Saharanpur",
    "meerut": "Meerut",
    "bareilly": "Bareilly",
    "aligarh": "Aligarh",
    "allahabad": "Allahabad",
    "varanasi": "Varanasi",
    "gorakhpur": "Gorakhpur",
    "moradabad": "Moradabad",
}

# City -> (latitude, longitude).
CITY_COORDS = {
    "Mumbai": (19.0760, 72.8777),
    "Delhi": (28.6139, 77.2090),
    "Bangalore": (12.9716, 77.5946),
    "Chennai": (13.0827, 80.2707),
    "Pune": (18.5204, 73.8567),
    "Kolkata": (22.5726, 88.3639),
    "Ahmedabad": (23.0225, 72.5714),
    "Hyderabad": (17.3850, 78.4867),
    "Jaipur": (26.9124, 75.7873),
    "Surat": (21.1702, 72.8311),
    "Nagpur": (21.1458, 79.0882),
    "Kanpur": (26.4499, 80.3319),
    "Lucknow": (26.8467, 80.9462),
    "Indore": (22.7196, 75.8577),
    "Coimbatore": (11.0168, 76.9558),
    "Kochi": (9.9312, 76.2673),
    "Visakhapatnam": (17.6868, 83.2185),
    "Patna": (25.5941, 85.1376),
    "Vadodara": (22.3072, 73.1812),
    "Bhubaneswar": (20.2961, 85.8245),
    "Chandigarh": (30.7333, 76.7794),
    "Ludhiana": (30.9010, 75.8573),
    "Saharanpur": (29.9680, 77.5552),
    "Meerut": (28.9845, 77.7064),
    "Bareilly": (28.3670, 79.4304),
    "Aligarh": (27.8974, 78.0880),
    "Allahabad": (25.4358, 81.8463),
    "Varanasi": (25.3176, 82.9739),
    "Gorakhpur": (26.7606, 83.3732),
    "Moradabad": (28.8386, 78.7733),
}

# Category aliases (case-folded) -> canonical category.
CATEGORY_ALIASES = {
    "electronics": "Electronics",
    "electronic": "Electronics",
    "electronics & accessories": "Electronics",
    "electronicss": "Electronics",
}

# Boolean spellings (after trim + lower-case).
TRUE_VALUES = ["true", "yes", "1", "y", "t"]
FALSE_VALUES = ["false", "no", "0", "n", "f"]

# Payment aliases (case-folded, '_' -> ' ') -> canonical method.
PAYMENT_ALIASES = {
    "upi": "UPI",
    "phonepe": "UPI",
    "phone pe": "UPI",
    "googlepay": "UPI",
    "google pay": "UPI",
    "gpay": "UPI",
    "g pay": "UPI",
    "credit card": "Credit Card",
    "credit_card": "Credit Card",
    "creditcard": "Credit Card",
    "cc": "Credit Card",
    "debit card": "Debit Card",
    "debit_card": "Debit Card",
    "debitcard": "Debit Card",
    "dc": "Debit Card",
    "cod": "COD",
    "cash on delivery": "COD",
    "c.o.d": "COD",
    "c.o.d.": "COD",
    "cashondelivery": "COD",
    "net banking": "Net Banking",
    "net_banking": "Net Banking",
    "netbanking": "Net Banking",
    "nb": "Net Banking",
    "wallet": "Wallet",
    "amazon pay": "Wallet",
    "amazonpay": "Wallet",
    "bnpl": "BNPL",
    "buy now pay later": "BNPL",
    "emi": "BNPL",
}

# Canonical payment method -> payment group ("Other" when absent).
PAYMENT_HIERARCHY = {
    "UPI": "Digital Payments",
    "Wallet": "Digital Payments",
    "Credit Card": "Card Payments",
    "Debit Card": "Card Payments",
    "Net Banking": "Bank Transfer",
    "BNPL": "Buy Now Pay Later",
    "COD": "Cash on Delivery",
}

# Default delivery days by delivery type (unknown type -> 3).
DELIVERY_TYPE_DAYS = {
    "Same Day": 1,
    "Express": 2,
    "Standard": 3,
}
DEFAULT_DELIVERY_DAYS = 3

# Delivery SLA by type: the EDA question uses Standard = 7, the operations
# page uses Standard = 5.
SLA_EDA = {"Same Day": 1, "Express": 2, "Standard": 7}
SLA_OPERATIONS = {"Same Day": 1, "Express": 2, "Standard": 5}

# RFM segment -> recommended action.
RFM_SEGMENT_MAP = {
    "Champions": "Recent, frequent, high spend — reward and retain",
    "Loyal Customers": "Buy often and spend well — upsell and loyalty offers",
    "Potential Loyalists": "Recent with growing frequency — membership and bundles",
    "New Customers": "Recent but low frequency — onboarding and first-repeat offers",
    "Promising": "Recent, low spend — category education and discounts",
    "Need Attention": "Above-average but fading — win-back campaigns",
    "About to Sleep": "Slipping recency and frequency — reactivation",
    "At Risk": "Were valuable, now stale — personalised win-back",
    "Cannot Lose Them": "High spend, low recency — immediate retention",
    "Hibernating": "Low activity across RFM — low-cost reactivation or ignore",
    "Lost": "Long inactive, low value — do not over-invest",
}

# Fixed bin edges and labels.
DISCOUNT_BAND_EDGES = [-0.01, 0, 10, 20, 30, 50, 80]
DISCOUNT_BAND_LABELS = ["0%", "0-10", "10-20", "20-30", "30-50", "50+"]
FREQUENCY_BAND_EDGES = [0, 1, 2, 4, 8, 10_000]
FREQUENCY_BAND_LABELS = ["1 order", "2", "3-4", "5-8", "9+"]
PRICE_QUINTILE_LABELS = ["Q1 cheap", "Q2", "Q3", "Q4", "Q5 expensive"]
PRICE_QUARTILE_LABELS = ["Low", "Mid-Low", "Mid-High", "High"]
AGE_ORDER = ["18-25", "26-35", "36-45", "46-55", "55+", "Unknown"]
TIER_ORDER = ["Metro", "Tier1", "Tier2", "Rural"]

# Business constants.
COGS_SHARE = 0.72            # cost-of-goods proxy, share of discounted price
TARGET_UPLIFT = 1.10         # monthly target = same month last year x 1.10
ALERT_BELOW = 0.9            # alert when actual < 0.9 x target
FORECAST_HORIZON = 6         # months
CHURN_DAYS = 365
DECIMAL_SHIFT_100 = (50, 500)
DECIMAL_SHIFT_10 = (5, 20)
PRICE_REL_ERROR_MAX = 0.5
ALERT_RETURN_RATE = 0.08
ALERT_DELIVERY_DAYS = 4
ALERT_CHURN_RATE = 0.35
ALERT_TEXTS = [
    "Revenue down versus last year in the current filter.",
    "Return rate above 8%.",
    "Average delivery slower than 4 days.",
    "More than 35% of customers look churned (365+ days inactive).",
]
# ------------------------------------------------------------ END FIXED VALUES
