"""Values that must be exactly these for results to be right.

Fixed values: source codes, the labels they become, and the labels the reports
print. Nothing here is derived.
"""

UNKNOWN = "n/a"

MARITAL_STATUS = {"S": "Single", "M": "Married"}

CRM_GENDER = {"F": "Female", "M": "Male"}

ERP_GENDER = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}

PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}

COUNTRY = {"DE": "Germany", "US": "United States", "USA": "United States"}

ERP_CUSTOMER_PREFIX = "NAS"

ABOVE_AVERAGE, BELOW_AVERAGE, ON_AVERAGE = "Above Avg", "Below Avg", "Avg"

INCREASE, DECREASE, NO_CHANGE = "Increase", "Decrease", "No Change"
