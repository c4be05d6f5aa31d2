"""Declared shapes of the landing tables.

Column names and types are fixed values: they are the native names of each
source system and have to match the files those systems deliver.
"""

SAP_INVOICES = """
    invoice_id string, invoice_number string, vendor_id string, vendor_name string,
    invoice_date date, due_date date, invoice_amount decimal(18,2), currency_code string,
    payment_terms string, po_number string, line_description string, gl_account string,
    cost_center string, approval_status string, created_at timestamp_ntz,
    sap_company_code string, sap_document_type string"""

ORACLE_INVOICES = """
    inv_id string, inv_num string, supplier_id string, supplier_name string,
    inv_date date, payment_due_date date, total_amount decimal(18,2), currency string,
    terms_code string, purchase_order string, description string, account_code string,
    dept_code string, status string, creation_date timestamp_ntz,
    oracle_org_id string, oracle_source string"""

BAAN_INVOICES = """
    ban_invoice_id string, ban_invoice_ref string, ban_vendor_code string, ban_vendor_desc string,
    ban_inv_date date, ban_pay_date date, ban_amount decimal(18,2), ban_curr string,
    ban_pay_terms string, ban_po_ref string, ban_line_desc string, ban_gl_code string,
    ban_cost_ctr string, ban_status string, ban_created timestamp_ntz, ban_company string"""

WORKDAY_INVOICES = """
    wd_invoice_id string, wd_invoice_num string, wd_supplier_id string, wd_supplier_name string,
    wd_invoice_date date, wd_due_date date, wd_amount decimal(18,2), wd_currency string,
    wd_pay_terms string, wd_po_number string, wd_memo string, wd_ledger_account string,
    wd_cost_center string, wd_approval_status string, wd_created_date timestamp_ntz,
    wd_tenant_id string"""

CONFORMED_COLUMNS = [
    "invoice_id", "invoice_number", "vendor_id", "vendor_name", "invoice_date", "due_date",
    "invoice_amount", "currency_code", "payment_terms", "po_number", "line_description",
    "gl_account", "cost_center", "approval_status", "created_at", "source_system",
]

COUNTRY = "country_id long, country string, iso_currency string, iso_country string, city_id long, city string, city_population string"
FRANCHISE = "franchise_id long, first_name string, last_name string, city string, country string, e_mail string, phone_number string"
LOCATION = "location_id long, placekey string, location string, city string, region string, iso_country_code string, country string"
MENU = """menu_id long, menu_type_id long, menu_type string, truck_brand_name string, menu_item_id long,
    menu_item_name string, item_category string, item_subcategory string, cost_of_goods_usd decimal(38,4),
    sale_price_usd decimal(38,4), menu_item_health_metrics_obj string"""
TRUCK = """truck_id long, menu_type_id long, primary_city string, region string, iso_region string, country string,
    iso_country_code string, franchise_flag long, year long, make string, model string, ev_flag long,
    franchise_id long, truck_opening_date date"""
ORDER_HEADER = """order_id long, truck_id long, location_id double, customer_id long, discount_id string,
    shift_id long, shift_start_time string, shift_end_time string, order_channel string, order_ts timestamp_ntz,
    served_ts string, order_currency string, order_amount decimal(38,4), order_tax_amount string,
    order_discount_amount string, order_total decimal(38,4)"""
ORDER_DETAIL = """order_detail_id long, order_id long, menu_item_id long, discount_id string, line_number long,
    quantity decimal(5,0), unit_price decimal(38,4), price decimal(38,4), order_item_discount_amount string"""
CUSTOMER_LOYALTY = """customer_id long, first_name string, last_name string, city string, country string,
    postal_code string, preferred_language string, gender string, favourite_brand string, marital_status string,
    children_count string, sign_up_date date, birthday_date date, e_mail string, phone_number string"""

MARKETING_METRICS = "date date, category string, campaign_name string, impressions decimal(38,0), clicks decimal(38,0)"
PRODUCTS = "product_id decimal(38,0), product_name string, category string"
SALES = "date date, region string, product_id decimal(38,0), units_sold decimal(38,0), sales_amount decimal(38,2)"
SOCIAL_MEDIA = "date date, category string, platform string, influencer string, mentions decimal(38,0)"
SUPPORT_CASES = "id string, title string, product string, transcript string, date date"

GOLDEN_QUESTIONS = "id string, category string, question string, expected_answer string, expected_sql string, check string"
BUSINESS_RULES = "rule_id string, category string, description string, decision string"
COLUMN_MAPPING = """source_system string, source_column string, source_type string, target_column string,
    target_type string, required string, transform string, notes string, status string"""
SOURCE_ONBOARDING = """request_id string, requested_by string, submitted string, priority string, source string,
    platform string, region string, go_live string, status string, notes string"""

REFRESH_HISTORY = """name string, state string, state_code string, state_message string,
    refresh_start_time timestamp_ntz, refresh_end_time timestamp_ntz, data_timestamp timestamp_ntz,
    refresh_action string, refresh_trigger string, query_id string, statistics string, target_lag_sec long,
    graph_history_valid_from timestamp_ntz, inputs_with_changed_data array<struct<name:string,rows:long>>,
    reinit_reason string"""
SPANS = """trace_id string, span_id string, name string, data_timestamp timestamp_ntz, state string,
    state_reason string, start_timestamp timestamp_ntz, end_timestamp timestamp_ntz,
    links array<struct<span_id:string,trace_id:string>>"""

# Fields of the statistics JSON of one refresh (fixed values).
REFRESH_STATISTICS = {
    "compilationTimeMs": "bigint",
    "executionTimeMs": "bigint",
    "numInsertedRows": "bigint",
    "numDeletedRows": "bigint",
    "numCopiedRows": "bigint",
    "numAddedPartitions": "bigint",
    "numRemovedPartitions": "bigint",
    "queuedTimeMs": "bigint",
}
