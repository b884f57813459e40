"""Enforced schemas of the core marts.

Fixed values: column names, order, types and NOT NULL constraints.
"""

from cartwright.schema import struct

FCT_ORDERS = struct(
    """
    order_sk string!,
    order_id long!,
    customer_id long!,
    customer_key long,
    store_id long,
    order_date date,
    order_date_day date,
    order_week date,
    order_month date,
    first_payment_date date,
    minutes_to_payment long,
    order_status string!,
    channel string,
    shipping_city string,
    customer_segment string,
    customer_city string,
    customer_gender string,
    payment_methods_used string,
    is_completed boolean,
    is_bad_order boolean,
    is_split_payment boolean,
    has_late_payment boolean,
    gross_amount double,
    discount_total double,
    net_amount double,
    total_paid double,
    updated_at string,
    dbt_loaded_at timestamp_ntz!
    """
)

FCT_EVENTS = struct(
    """
    event_id string!,
    session_id string,
    customer_id double,
    product_id double,
    event_type string!,
    event_ts timestamp_ntz!,
    event_date date,
    event_hour int,
    channel string,
    device string,
    funnel_stage int,
    ingested_at string,
    batch_id string,
    dbt_loaded_at timestamp_ntz!
    """
)

DIM_CUSTOMERS_SCD = struct(
    """
    customer_key long!,
    customer_id long!,
    full_name string,
    email string,
    phone string,
    gender string,
    date_of_birth string,
    age_years long,
    generation_cohort string,
    city string,
    segment string,
    referral_code string,
    valid_from string!,
    valid_to string,
    is_current boolean!,
    has_scd_overlap boolean,
    updated_at string,
    valid_to_date_safe date
    """
)
