"""Fixed schemas of the input entities.

Field names are those of the source documents and extracts, so that reports
can be pointed at exported collections without renaming.
"""

from __future__ import annotations

ORDERS = """
    _id string, reference string, customer string, createdAt timestamp,
    state string, locationIdentifier string, invoice string,
    voucherCode string, languageCode string,
    chosenServiceClass struct<reference: string>,
    createdBy struct<userAgent: string>,
    subProcesses array<string>,
    referral struct<referrerId: string>,
    paymentData struct<provider: string>
"""

CUSTOMERS = """
    _id string, reference string,
    internalData struct<segmentation: string, gender: string, basketGender: string>,
    person struct<name: string>,
    userAccount struct<email: string>,
    addresses array<struct<addressLine: string, addressLine2: string, zip: string>>,
    phones array<struct<number: string, type: string>>,
    meta struct<tags: array<string>, language: string>
"""

INVOICES = """
    _id string, grossTotal double, grossTotalWithoutDiscounts double,
    netTotal double, netTotalWithoutDiscounts double
"""

EXCHANGE_RATES = """
    exchange_rate_date date, currency_code string, exchange_rate_value double
"""

NOTIFICATIONS = """
    _id string, email string, publicReference string, reference string,
    newsletterSubscribed boolean
"""

RATINGS = """
    _id string, appVersion string, orderReference string,
    customerReference string, rating int, skipped boolean,
    topics map<string, string>
"""

BRANCH_CREDITS = "reference string, branch_credits double, last_updated string"

VOUCHER_BLOCKS = "reference string, name string, campaignId string"
VOUCHER_MODELS = "_id string, blockId string, template string"
VOUCHER_ITEMS = "_id string, code string, modelId string"

FUNNEL = "order_reference string, first_channel string, last_channel string"

TRACKER_EVENTS = "_id string, reference_id string, network string, event string"

WEB_ANALYTICS = """
    `ga.transactionID` string, `ga.source` string, `ga.medium` string,
    `ga.keyword` string
"""

FACILITIES = "_id string, name string"
SUBPROCESSES = "_id string, fulfillment string, dropOff string"
DRIVER_DELIVERIES = "_id string, facility string"
