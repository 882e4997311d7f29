"""SQL counterparts of the registered queries, for DuckDB on the driver's tables.

Every statement is self-contained: the trip records are derived from ``lineitem`` and
``nation`` by the rules of ``verification/fixture.py`` and the models are stated again as
common table expressions. Sums and averages of doubles are exact and turned into doubles by the same
last steps on both engines, so they are compared to the last digit.
"""

from __future__ import annotations

_TRIPS = """
base as (
    select l_orderkey as o, l_partkey as p, l_suppkey as s, l_linenumber::bigint as n,
           l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, dupe,
           case l_returnflag when 'A' then 'yellow' when 'R' then 'green'
                             when 'N' then 'fhv' end as service,
           (l_orderkey * 7919 + l_linenumber::bigint * 104729 + l_partkey * 31) % 7862400
               as pickup_s,
           (l_partkey * 37 + l_suppkey * 101 + l_linenumber::bigint * 13) % 13000 - 400 as dur_s,
           floor(l_extendedprice) / 100.0::double
               * case when l_orderkey % 53 = 0 then -1.0::double else 1.0::double end as fare
    from (select *, 0 as dupe from lineitem
          union all
          select *, 1 as dupe from lineitem where l_orderkey % 50 = 7)
),
times as (
    select *, service <> 'fhv' as metered,
           case when o % 211 <> 0
                then timestamp '2024-01-01 00:00:00' + to_seconds(pickup_s) end as pickup,
           case when not (service = 'fhv' and o % 97 = 0)
                then timestamp '2024-01-01 00:00:00' + to_seconds(pickup_s + dur_s) end as dropoff,
           l_discount * fare + case when dupe = 1 then 1.0::double else 0.0::double end as tip,
           (n % 3) * 0.5::double as extra_money,
           l_tax * 10.0::double as tolls
    from base
),
raw as (
    select service, dupe,
           case when metered then (n % 3 + 1)::int end as "VendorID",
           case when service = 'yellow' then pickup end as tpep_pickup_datetime,
           case when service = 'yellow' then dropoff end as tpep_dropoff_datetime,
           case when service = 'green' then pickup end as lpep_pickup_datetime,
           case when service = 'green' then dropoff end as lpep_dropoff_datetime,
           case when service = 'fhv' then pickup end as pickup_datetime,
           case when service = 'fhv' then dropoff end as "dropOff_datetime",
           case when metered then n::double end as passenger_count,
           case when metered then case when o % 59 = 0 then 250.0::double
                                       when o % 61 = 0 then 0.0::double
                                       else l_quantity * 0.5::double end end as trip_distance,
           case when p % 89 <> 0 then
               (case s % 28 when 25 then 264 when 26 then 265 when 27 then 999 else s % 28 end)::int
           end as "PULocationID",
           (case p % 28 when 25 then 264 when 26 then 265 when 27 then 999 else p % 28 end)::int
               as "DOLocationID",
           case when metered then (n % 7 + 1)::double end as "RatecodeID",
           case when metered then case when l_linestatus = 'F' then 'Y' else 'N' end end
               as store_and_fwd_flag,
           case when metered then (s % 7)::int end as payment_type,
           case when metered then fare end as fare_amount,
           case when metered then extra_money end as extra,
           case when metered then 0.5::double end as mta_tax,
           case when metered then 0.3::double end as improvement_surcharge,
           case when metered then tip end as tip_amount,
           case when metered then tolls end as tolls_amount,
           case when metered then fare + tip + extra_money + 0.5::double + 0.3::double + tolls end
               as total_amount,
           case when service = 'green' then (n % 2 + 1)::double end as trip_type,
           case when service = 'fhv' then 'B' || s end as dispatching_base_num,
           case when service = 'fhv' then case n % 3 when 0 then 1 when 1 then 0 end end
               as "SR_Flag",
           case when service = 'fhv' and p % 5 <> 0 then 'B' || p end as "Affiliated_base_number"
    from times
)"""

_ZONES = """
raw_zones as (
    select n_nationkey::int as "LocationID",
           case when n_nationkey = 24 then 'EWR'
                when n_regionkey = 0 then 'Manhattan' when n_regionkey = 1 then 'Brooklyn'
                when n_regionkey = 2 then 'Queens' when n_regionkey = 3 then 'Bronx'
                else 'Staten Island' end as "Borough",
           case when n_nationkey = 24 then 'Newark Airport'
                when n_nationkey in (7, 12) then n_name || ' Airport' else n_name end as "Zone",
           case when n_nationkey = 24 then 'EWR' when n_nationkey in (7, 12) then 'Airports'
                when n_regionkey = 0 then 'Yellow Zone' else 'Boro Zone' end as service_zone
    from nation
    union all values (264, 'Unknown', 'N/A', 'N/A'), (265, 'N/A', 'Outside of NYC', 'N/A')
),
stg_taxi_zones as (
    select "LocationID" as zone_id, "Borough" as borough, "Zone" as zone_name, service_zone
    from raw_zones
),
dim_zones as (
    select zone_id, borough, zone_name, service_zone,
           service_zone = 'Airports' or zone_name like '%Airport%' as is_airport,
           service_zone = 'Yellow Zone' as is_yellow_zone,
           borough in ('Manhattan', 'Brooklyn', 'Queens', 'Bronx', 'Staten Island')
               as is_nyc_borough
    from stg_taxi_zones where zone_id not in (264, 265)
)"""


def _key(*columns: str) -> str:
    texts = (f"coalesce({column}::varchar, '')" for column in columns)
    return "md5(" + " || '|' || ".join(texts) + ")"


def _metered(service: str, prefix: str, own: str = "") -> str:
    key = _key(
        f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime", '"PULocationID"',
        '"DOLocationID"', "fare_amount", "trip_distance", "passenger_count",
    )
    return f"""
keyed_{service} as (
    select {key} as base_hash, '{service}' as trip_type, dupe,
           {prefix}_pickup_datetime as pickup_datetime,
           {prefix}_dropoff_datetime as dropoff_datetime,
           "PULocationID" as pickup_zone_id, "DOLocationID" as dropoff_zone_id,
           passenger_count::int as passenger_count, trip_distance, fare_amount, extra, mta_tax,
           improvement_surcharge, tip_amount, tolls_amount, total_amount,
           "VendorID"::int as vendor_id, "RatecodeID"::int as rate_code_id,
           store_and_fwd_flag, payment_type::int as payment_type {own}
    from raw
    where service = '{service}' and {prefix}_pickup_datetime is not null
      and {prefix}_dropoff_datetime is not null
),
stg_{service}_trips as (
    select base_hash || '_' || row_number() over (
               partition by base_hash
               order by extra nulls first, mta_tax nulls first, improvement_surcharge nulls first,
                        tip_amount nulls first, tolls_amount nulls first,
                        total_amount nulls first, vendor_id nulls first,
                        rate_code_id nulls first, store_and_fwd_flag nulls first,
                        payment_type nulls first {', green_trip_type nulls first' if own else ''}
           ) as trip_id, * exclude (base_hash)
    from keyed_{service}
)"""


_FHV_KEY = _key(
    "pickup_datetime", '"dropOff_datetime"', '"PULocationID"', '"DOLocationID"',
    "dispatching_base_num", '"Affiliated_base_number"', '"SR_Flag"',
)

_STAGED = ",".join(
    [
        _metered("yellow", "tpep"),
        _metered("green", "lpep", ", trip_type::int as green_trip_type"),
        f"""
keyed_fhv as (
    select {_FHV_KEY} as base_hash, 'fhv' as trip_type, dupe, pickup_datetime,
           "dropOff_datetime" as dropoff_datetime, "PULocationID" as pickup_zone_id,
           "DOLocationID" as dropoff_zone_id, dispatching_base_num,
           "Affiliated_base_number" as affiliated_base_num,
           coalesce("SR_Flag" = 1, false) as is_shared_ride
    from raw where service = 'fhv' and pickup_datetime is not null
),
stg_fhv_trips as (
    select base_hash || '_' || row_number() over (partition by base_hash) as trip_id,
           * exclude (base_hash)
    from keyed_fhv
)""",
    ]
)

_SHARED = """trip_id, trip_type, pickup_datetime, dropoff_datetime, pickup_zone_id,
    dropoff_zone_id"""
_METER = """passenger_count, trip_distance, fare_amount, extra, mta_tax, improvement_surcharge,
    tip_amount, tolls_amount, total_amount, vendor_id, rate_code_id, payment_type"""


def _union(source: str, ids: bool) -> str:
    """The union over the staged services (``stg``) or their keyed rows without ids."""
    tables = {s: f"stg_{s}_trips" if ids else f"keyed_{s}" for s in ("yellow", "green", "fhv")}
    shared = _SHARED if ids else _SHARED.replace("trip_id, ", "")
    padding = ", ".join(f"null as {c.strip()}" for c in _METER.split(","))
    return f"""
{source} as (
    select {shared}, dupe, {_METER} from {tables['yellow']}
    union all select {shared}, dupe, {_METER} from {tables['green']}
    union all select {shared}, dupe, {padding} from {tables['fhv']}
)"""


def _enriched(source: str, target: str) -> str:
    minutes = "datediff('minute', pickup_datetime, dropoff_datetime)"
    return f"""
{target} as (
    select t.*, pz.zone_name as pickup_zone_name, pz.borough as pickup_borough,
           pz.service_zone as pickup_service_zone, dz.zone_name as dropoff_zone_name,
           dz.borough as dropoff_borough, dz.service_zone as dropoff_service_zone,
           {minutes} as trip_duration_minutes,
           case when trip_distance > 0 and {minutes} > 0
                then trip_distance / ({minutes} / 60.0::double) end as avg_speed_mph,
           case when fare_amount > 0 and tip_amount is not null
                then tip_amount / fare_amount * 100 end as tip_percentage
    from {source} t
    left join stg_taxi_zones pz on t.pickup_zone_id = pz.zone_id
    left join stg_taxi_zones dz on t.dropoff_zone_id = dz.zone_id
)"""


_RULES = {
    "duration": "trip_duration_minutes > 0 and trip_duration_minutes < 180",
    "fare": "trip_type = 'fhv' or (fare_amount > 0 and fare_amount < 1000)",
    "distance": "trip_type = 'fhv' or (trip_distance >= 0 and trip_distance < 200)",
    "speed": "trip_type = 'fhv' or avg_speed_mph is null or avg_speed_mph < 100",
    "zone": "pickup_zone_id is not null and pickup_zone_id not in (264, 265)",
}
_VALID = " and ".join(f"({rule})" for rule in _RULES.values())


_STEP = "2147483648"
_FINEST = f"{1 << 93}::hugeint"


def _total(column: str) -> str:
    """Sum of doubles as a whole number of units of 2**-93, which the values of the test tables are whole numbers of."""
    x = f"({column})::double"
    rest = f"(({x}) - trunc({x})) * {1 << 62}::double"
    low = f"trunc(({rest} - trunc({rest})) * {_STEP}::double)::bigint"
    return (
        f"sum(trunc({x})::bigint)::hugeint * {_FINEST} + sum(trunc({rest})::bigint)::hugeint * {_STEP}::hugeint"
        f" + sum({low})::hugeint"
    )


def _double(total: str) -> str:
    """The double of such a total, from its magnitude's digits to the base of 2**31."""
    size, below = f"abs({total})", f"{_STEP}::double"
    first = f"({size} // {_FINEST})::double"
    digits = [f"(({size} // {1 << bits}::hugeint) % {_STEP}::hugeint)::double" for bits in (62, 31, 0)]
    value = f"({digits[0]} + ({digits[1]} + {digits[2]} / {below}) / {below}) / {below}"
    return f"({first} + {value}) * case when {total} < 0 then -1.0::double else 1.0::double end"


def _sum(name: str) -> str:
    return f"{_double(f'sum_of_{name}')}"


def _avg(name: str) -> str:
    return f"({_double(f'sum_of_{name}')}) / nullif(n_of_{name}, 0)::double"


def _totals(**columns: str) -> str:
    """Totals and numbers of values, to be turned into sums and averages by an outer query."""
    return ", ".join(
        f"{_total(column)} as sum_of_{name}, count({column}) as n_of_{name}" for name, column in columns.items()
    )


_MINUTES = "sum(trip_duration_minutes)::double / count(trip_duration_minutes)::double"


def _daily(source: str) -> str:
    return f"""
    select trip_date, pickup_borough, trip_type, total_trips, total_passengers,
           coalesce({_sum('miles')}, 0) as total_distance_miles, {_avg('miles')} as avg_distance_miles,
           coalesce({_sum('fare')}, 0) as total_fare, {_avg('fare')} as avg_fare,
           coalesce({_sum('tips')}, 0) as total_tips, {_avg('tip_share')} as avg_tip_percentage,
           avg_duration_minutes
    from (select pickup_datetime::date as trip_date, pickup_borough, trip_type,
                 count(*) as total_trips, sum(coalesce(passenger_count, 0))::bigint as total_passengers,
                 {_totals(miles='trip_distance', fare='fare_amount', tips='tip_amount', tip_share='tip_percentage')},
                 {_MINUTES} as avg_duration_minutes
          from {source} where pickup_borough is not null group by all)"""


def _pickups(source: str) -> str:
    return f"""
    select zone_id, metric_date, trip_type, pickups, coalesce({_sum('fare')}, 0) as total_fare_from_zone,
           {_avg('fare')} as avg_fare_from_zone, {_avg('miles')} as avg_distance_from_zone, avg_duration_from_zone
    from (select pickup_zone_id as zone_id, pickup_datetime::date as metric_date, trip_type,
                 count(*) as pickups, {_totals(fare='fare_amount', miles='trip_distance')},
                 {_MINUTES} as avg_duration_from_zone
          from {source} where pickup_zone_id is not null group by all)"""


def _dropoffs(source: str) -> str:
    return f"""
    select dropoff_zone_id as zone_id, pickup_datetime::date as metric_date, trip_type,
           count(*) as dropoffs
    from {source} where dropoff_zone_id is not null group by all"""


def _zone_fact(source: str) -> str:
    return f"""
    select zone_id, metric_date, trip_type, coalesce(pickups, 0) as pickups,
           coalesce(dropoffs, 0) as dropoffs, total_fare_from_zone, avg_fare_from_zone,
           avg_distance_from_zone, avg_duration_from_zone
    from ({_pickups(source)}) full join ({_dropoffs(source)})
         using (zone_id, metric_date, trip_type)"""


# Trips without ids serve everything that does not look at ids.
_PLAIN = ",".join(
    [
        _TRIPS, _ZONES, _STAGED, _union("trips", ids=False), _enriched("trips", "enriched"),
        f"\nvalidated as (select * from enriched where {_VALID})",
    ]
)
_FACTS = f"{_PLAIN},\ndaily as ({_daily('validated')}),\nzone_fact as ({_zone_fact('validated')})"
_WITH_IDS = ",".join(
    [
        _FACTS, _union("int_trips_unioned", ids=True),
        _enriched("int_trips_unioned", "int_trips_enriched"),
        f"\nint_trips_validated as (select * from int_trips_enriched where {_VALID})",
        "\nfct_daily_trips as (select * from daily)",
        "\nfct_zone_metrics as (select * from zone_fact)",
    ]
)


def _from(tables: str, select: str) -> str:
    return f"with {tables.strip()}\n{select.strip()}\n"


def _plain(select: str) -> str:
    return _from(_PLAIN, select)


def _facts(select: str) -> str:
    return _from(_FACTS, select)


def _ids(select: str) -> str:
    return _from(_WITH_IDS, select)


# Types that the files of several widths store: as declared, in the widest integers, as doubles.
_WIDTHS = {
    "VendorID": ("int", "int", "bigint", "double"),
    "tpep_pickup_datetime": ("timestamp_ntz",) * 4,
    "tpep_dropoff_datetime": ("timestamp_ntz",) * 4,
    "passenger_count": ("double", "double", "bigint", "double"),
    "trip_distance": ("double",) * 4,
    "PULocationID": ("int", "int", "bigint", "double"),
    "DOLocationID": ("int", "int", "bigint", "double"),
    "RatecodeID": ("double",) * 4,
    "store_and_fwd_flag": ("string",) * 4,
    "payment_type": ("int", "int", "bigint", "double"),
    **{
        name: ("double",) * 4
        for name in ("fare_amount", "extra", "mta_tax", "improvement_surcharge", "tip_amount", "tolls_amount")
    },
    # One column that the contract leaves out, and one that no file has.
    "total_amount": (None, "double", "double", "double"),
    "airport_fee": ("double", None, None, None),
}


def _stored_types() -> str:
    def text(value: str | None) -> str:
        return "null::varchar" if value is None else f"'{value}'"

    lines = ", ".join(
        f"({k}, '{name}', {text(kinds[0])}, {text(kinds[1 + k])})" for name, kinds in _WIDTHS.items() for k in range(3)
    )
    return f"""
select column_name, expected_type, stored_type, sum(n)::bigint as stored_rows,
       case when stored_type is null then 'missing' when expected_type is null then 'unexpected'
            when expected_type = stored_type then 'ok' else 'type differs' end as status
from (values {lines}) as t(part, column_name, expected_type, stored_type)
join (select coalesce("VendorID", 0) % 3 as part, count(*) as n from raw where service = 'yellow' group by 1) using (part)
group by all"""


ORACLES: dict[str, str] = {
    # Sources
    "scan_trips": _plain("select * exclude (dupe) from raw"),
    "scan_widths": _plain(
        """select "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
               trip_distance, "PULocationID", "DOLocationID", "RatecodeID", store_and_fwd_flag,
               payment_type, fare_amount, extra, mta_tax, improvement_surcharge, tip_amount,
               tolls_amount, total_amount from raw where service = 'yellow'"""
    ),
    "stream_widths": _plain("select * exclude (dupe) from trips where trip_type = 'yellow'"),
    "stored_contract": _plain(_stored_types()),
    "landing_profile": _plain(
        """select service, strftime(coalesce(tpep_pickup_datetime, lpep_pickup_datetime, pickup_datetime,
                                          timestamp '2024-01-01 00:00:00'), '%Y-%m') as month,
               count(*) as stored_rows, true as sizes_agree, 0::bigint as unreadable
        from raw group by all"""
    ),
    "scan_zones": _plain("select * from raw_zones"),
    "seed_zones": _plain("select * from raw_zones"),
    "union_available": _plain("select * exclude (dupe) from trips where trip_type <> 'fhv'"),
    "source_counts": _plain(
        "select service as source_name, count(*) as row_count from raw group by service"
        " union all select 'zones', count(*) from raw_zones"
    ),
    "landing_gaps": _plain(
        """select service, month
           from (values ('yellow'), ('green'), ('fhv')) s(service),
                (values ('2024-01'), ('2024-02'), ('2024-03'), ('2024-04')) m(month)
           except
           select service, strftime(coalesce(tpep_pickup_datetime, lpep_pickup_datetime,
               pickup_datetime, timestamp '2024-01-01'), '%Y-%m') from raw"""
    ),
    "landing_summary": _plain(
        """select count(distinct service || strftime(coalesce(tpep_pickup_datetime,
               lpep_pickup_datetime, pickup_datetime, timestamp '2024-01-01'), '%Y-%m')) as files,
               true as has_bytes from raw"""
    ),
    "surrogate_ids": _plain(
        "select count(*) as rows_in, count(*) as distinct_ids from trips where trip_type = 'yellow'"
    ),
    "catalog_listing": _plain(
        "select service || '_tripdata' as table_name, count(*) as row_count"
        " from raw group by service union all select 'nations', count(*) from nation"
    ),
    # Bronze
    "stg_yellow": _plain("select * exclude (dupe) from stg_yellow_trips"),
    "stg_green": _plain("select * exclude (dupe) from stg_green_trips"),
    "stg_fhv": _plain("select * exclude (dupe) from stg_fhv_trips"),
    "stg_zones": _plain("select * from stg_taxi_zones"),
    "cast_round": _plain(
        "select trip_distance, trip_distance::int as whole_miles, count(*) as trips"
        " from raw group by all"
    ),
    "trip_ids": _ids("select trip_id, trip_type, pickup_datetime, tip_amount from"
                     " int_trips_unioned"),
    # Silver
    "trips_unioned": _ids("select * exclude (dupe) from int_trips_unioned"),
    "trip_duration": _plain(
        "select trip_type, pickup_datetime, dropoff_datetime, trip_duration_minutes from enriched"
    ),
    "avg_speed": _plain(
        "select trip_type, trip_distance, trip_duration_minutes, avg_speed_mph from enriched"
    ),
    "tip_percentage": _plain(
        "select trip_type, fare_amount, tip_amount, tip_percentage from enriched"
    ),
    "trips_enriched": _ids("select * exclude (dupe) from int_trips_enriched"),
    "rejects_by_rule": _plain(
        "select trip_type, count(*) as trips, "
        + ", ".join(
            f"count(*) filter (where not coalesce({rule}, false)) as failed_{name}"
            for name, rule in _RULES.items()
        )
        + f", count(*) filter (where not coalesce({_VALID}, false)) as rejected"
        " from enriched group by trip_type"
    ),
    "trips_validated": _ids("select * exclude (dupe) from int_trips_validated"),
    # Gold
    "dim_zones": _plain("select * from dim_zones"),
    "daily_trips": _facts("select * from daily"),
    "pickup_metrics": _plain(_pickups("validated")),
    "dropoff_metrics": _plain(_dropoffs("validated")),
    "zone_metrics": _facts("select * from zone_fact"),
    "zone_metrics_join": _facts("select * from zone_fact"),
    "daily_summary": _facts(
        "select trip_date, pickup_borough, trip_type, total_trips, avg_fare, avg_duration_minutes"
        " from daily where trip_date >= date '2024-02-15' order by trip_date, total_trips desc"
    ),
    "busiest_zones": _facts(
        """select zone_name, borough, sum(pickups)::bigint as total_pickups,
                  sum(dropoffs)::bigint as total_dropoffs
           from zone_fact join dim_zones using (zone_id) group by zone_name, borough
           order by total_pickups desc, zone_name, borough limit 10"""
    ),
    "high_water_mark": _facts("select max(trip_date) as high_water_mark from daily"),
}

for _name, _rule in _RULES.items():
    ORACLES[f"rule_{_name}"] = _plain(
        f"""select trip_type, pickup_datetime, dropoff_datetime, pickup_zone_id, fare_amount,
                   trip_distance, trip_duration_minutes, avg_speed_mph
            from enriched where {_rule}"""
    )

ORACLES["lookback_slice"] = _facts(
    """select trip_type, pickup_datetime, dropoff_datetime, pickup_zone_id, fare_amount,
              trip_distance, trip_duration_minutes, avg_speed_mph
       from validated
       where pickup_datetime >= (select max(trip_date) from daily) - interval 3 day"""
)


def _labels(column: str, labels: dict[int, str]) -> str:
    cases = " ".join(f"when {code} then '{label}'" for code, label in labels.items())
    return f"case {column} {cases} end"


ORACLES["decode_codes"] = _plain(
    "select payment_type, rate_code_id, vendor_id, "
    + _labels(
        "payment_type",
        {1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute", 5: "Unknown",
         6: "Voided trip"},
    )
    + " as payment_label, "
    + _labels(
        "rate_code_id",
        {1: "Standard rate", 2: "JFK", 3: "Newark", 4: "Nassau or Westchester",
         5: "Negotiated fare", 6: "Group ride"},
    )
    + " as rate_label, "
    + _labels("vendor_id", {1: "Creative Mobile", 2: "VeriFone"})
    + " as vendor_label, count(*) as trips from trips group by all"
)

# The simpler design variant: yellow trips only, speed 0 without distance, no speed for a
# duration of zero (those rows are filtered anyway).
_SIMPLE = f"""{_PLAIN},
simple as (
    select pickup_datetime, dropoff_datetime, pickup_zone_id, dropoff_zone_id, passenger_count,
           trip_distance, fare_amount, tip_amount, total_amount, pickup_zone_name,
           pickup_borough, dropoff_zone_name, dropoff_borough, trip_duration_minutes,
           case when trip_distance > 0
                then trip_distance / nullif(trip_duration_minutes / 60.0::double, 0)
                else 0 end as avg_speed_mph
    from enriched
    where trip_type = 'yellow' and trip_duration_minutes > 0 and trip_duration_minutes < 180
      and fare_amount > 0
)"""
ORACLES["spec_enriched"] = _from(_SIMPLE, "select * from simple")
ORACLES["spec_daily"] = _from(
    _SIMPLE,
    f"""select trip_date, pickup_borough, total_trips, total_passengers,
               {_sum('miles')} as total_distance_miles, {_avg('miles')} as avg_distance_miles,
               {_sum('fare')} as total_fares, {_avg('fare')} as avg_fare, {_sum('tips')} as total_tips,
               {_avg('share')} as avg_tip_percentage, avg_duration_minutes
        from (select pickup_datetime::date as trip_date, pickup_borough, count(*) as total_trips,
                     sum(passenger_count)::bigint as total_passengers,
                     {_totals(miles='trip_distance', fare='fare_amount', tips='tip_amount',
                              share='tip_amount / nullif(fare_amount, 0)')},
                     {_MINUTES} as avg_duration_minutes
              from simple group by all)""",
)


def _loaded_twice(fact: str, day: str, keys: str, replace: bool = False) -> str:
    """First load: first copies before March. Second load: everything within the lookback."""
    same = f"new.{day} = old.{day}" if replace else " and ".join(
        f"new.{key} = old.{key}" for key in keys.split(", ")
    )
    build = {"daily": _daily, "zone": _zone_fact}[fact]
    return f"""{_PLAIN},
first_trips as (
    select * from validated where dupe = 0 and pickup_datetime < timestamp '2024-03-01'
),
old as ({build('first_trips')}),
recent_trips as (
    select * from validated
    where pickup_datetime >= (select max({day}) from old) - interval 3 day
),
new as ({build('recent_trips')}),
merged as (
    select * from old where not exists (select 1 from new where {same})
    union all select * from new
)"""


_DAILY_KEYS = "trip_date, pickup_borough, trip_type"
_ZONE_KEYS = "zone_id, metric_date, trip_type"
ORACLES["incremental_daily"] = _from(
    _loaded_twice("daily", "trip_date", _DAILY_KEYS), "select * from merged"
)
ORACLES["incremental_daily_replace"] = _from(
    _loaded_twice("daily", "trip_date", _DAILY_KEYS, replace=True), "select * from merged"
)
ORACLES["incremental_zone"] = _from(
    _loaded_twice("zone", "metric_date", _ZONE_KEYS), "select * from merged"
)

# Streams end where the batch ends. Only days that a later event has passed by more than
# the lookback are closed.
ORACLES["ingest_new_files"] = _plain("select * exclude (dupe) from trips")
ORACLES["stream_daily"] = ORACLES["daily_trips"]
ORACLES["stream_daily_counts"] = """
select ts::date as event_date, event_type, count(*) as events
from events
where ts::date + interval 1 day <= (select max(ts) from events) - interval 3 day
group by all
"""

# Quality: (model, column, kind, failing rows or values)
_SERVICES = "('yellow', 'green', 'fhv')"


def _null_rows(model: str, column: str) -> tuple[str, str, str, str]:
    return model, column, "not_null", f"select count(*) from {model} where {column} is null"


def _repeated(model: str, column: str) -> tuple[str, str, str, str]:
    keys = column.replace(",", ", ")
    filled = " and ".join(f"{k} is not null" for k in column.split(","))
    groups = f"select {keys} from {model} where {filled} group by {keys} having count(*) > 1"
    return model, column, "unique", f"select count(*) from ({groups})"


def _odd_values(model: str, column: str, allowed: str) -> tuple[str, str, str, str]:
    return (
        model, column, "accepted_values",
        f"select count(distinct {column}) from {model} where {column} not in {allowed}",
    )


def _out_of_range(model: str, column: str, bad: str) -> tuple[str, str, str, str]:
    return model, column, "accepted_range", f"select count(*) from {model} where {bad}"


_CHECKS: list[tuple[str, str, str, str]] = []
for _service in ("yellow", "green", "fhv"):
    _model = f"stg_{_service}_trips"
    _CHECKS += [
        _repeated(_model, "trip_id"), _null_rows(_model, "trip_id"),
        _odd_values(_model, "trip_type", f"('{_service}')"),
        _null_rows(_model, "pickup_datetime"),
    ]
    if _service != "fhv":
        _CHECKS.append(_null_rows(_model, "dropoff_datetime"))
for _model in ("int_trips_unioned", "int_trips_enriched", "int_trips_validated"):
    _CHECKS += [
        _repeated(_model, "trip_id"), _null_rows(_model, "trip_id"),
        _null_rows(_model, "trip_type"),
    ]
_CHECKS += [
    _odd_values("int_trips_unioned", "trip_type", _SERVICES),
    _null_rows("int_trips_unioned", "pickup_datetime"),
    _out_of_range("int_trips_validated", "trip_duration_minutes",
                  "trip_duration_minutes <= 0 or trip_duration_minutes >= 180"),
]
for _model in ("stg_taxi_zones", "dim_zones"):
    _CHECKS.append(_repeated(_model, "zone_id"))
    _CHECKS += [_null_rows(_model, c) for c in ("zone_id", "borough", "zone_name")]
_CHECKS += [_null_rows("fct_daily_trips", c) for c in _DAILY_KEYS.split(", ")]
_CHECKS += [
    _odd_values("fct_daily_trips", "trip_type", _SERVICES),
    _null_rows("fct_daily_trips", "total_trips"),
    _out_of_range("fct_daily_trips", "total_trips", "total_trips < 0"),
]
_CHECKS += [_null_rows("fct_zone_metrics", c) for c in _ZONE_KEYS.split(", ")]
_UNIQUE_KEYS = [
    _repeated("fct_daily_trips", _DAILY_KEYS.replace(", ", ",")),
    _repeated("fct_zone_metrics", _ZONE_KEYS.replace(", ", ",")),
]
_METERED_RULES = [
    _out_of_range("int_trips_validated", "fare_amount",
                  "trip_type <> 'fhv' and fare_amount <= 0"),
    _out_of_range("int_trips_validated", "trip_distance",
                  "trip_type <> 'fhv' and trip_distance < 0"),
]
_RELATIONSHIPS = (
    "fct_zone_metrics", "zone_id", "relationships",
    "select count(*) from fct_zone_metrics where zone_id is not null"
    " and zone_id not in (select zone_id from dim_zones)",
)


def _check_rows(checks: list[tuple[str, str, str, str]]) -> str:
    # Models are read by many checks, so each is computed once.
    tables = _WITH_IDS.replace(" as (\n    select", " as materialized (\n    select")
    rows = "\nunion all ".join(
        f"select '{model}' as model, '{column}' as column_name, '{kind}' as check_name,"
        f" ({failing}) as failures"
        for model, column, kind, failing in checks
    )
    return _from(tables, rows)


_ALL_CHECKS = [*_CHECKS, *_UNIQUE_KEYS, *_METERED_RULES]
for _kind in ("not_null", "unique", "accepted_values", "accepted_range"):
    ORACLES[f"dq_{_kind}"] = _check_rows([c for c in _ALL_CHECKS if c[2] == _kind])
ORACLES["dq_unique_key"] = _check_rows(_UNIQUE_KEYS)
ORACLES["dq_metered_rules"] = _check_rows(_METERED_RULES)
ORACLES["dq_report"] = _check_rows([*_ALL_CHECKS, _RELATIONSHIPS])
ORACLES["dq_stored"] = ORACLES["dq_report"]
ORACLES["enriched_view"] = ORACLES["trips_enriched"]
ORACLES["dq_relationships"] = _facts(
    """select zone_id, count(*) as fact_rows from zone_fact
       where zone_id not in (select zone_id from dim_zones) group by zone_id"""
)

# Contract: every column of every model with its type and the number of filled rows.
_STAMPS = ("loaded_at", "updated_at")


# The columns of the models and their types, stated apart from the code under test.
_METERED_COLUMNS = """trip_id trip_type pickup_datetime dropoff_datetime pickup_zone_id dropoff_zone_id
    passenger_count trip_distance fare_amount extra mta_tax improvement_surcharge tip_amount tolls_amount
    total_amount vendor_id rate_code_id"""
_UNIONED_COLUMNS = _METERED_COLUMNS + " payment_type loaded_at"
_ENRICHED_COLUMNS = _UNIONED_COLUMNS + """ pickup_zone_name pickup_borough pickup_service_zone
    dropoff_zone_name dropoff_borough dropoff_service_zone trip_duration_minutes avg_speed_mph tip_percentage"""
_COLUMNS = {
    "stg_yellow_trips": _METERED_COLUMNS + " store_and_fwd_flag payment_type loaded_at",
    "stg_green_trips": _METERED_COLUMNS + " store_and_fwd_flag payment_type green_trip_type loaded_at",
    "stg_fhv_trips": """trip_id trip_type pickup_datetime dropoff_datetime pickup_zone_id dropoff_zone_id
        dispatching_base_num affiliated_base_num is_shared_ride loaded_at""",
    "stg_taxi_zones": "zone_id borough zone_name service_zone loaded_at",
    "int_trips_unioned": _UNIONED_COLUMNS,
    "int_trips_enriched": _ENRICHED_COLUMNS,
    "int_trips_validated": _ENRICHED_COLUMNS,
    "dim_zones": "zone_id borough zone_name service_zone is_airport is_yellow_zone is_nyc_borough loaded_at",
    "fct_daily_trips": """trip_date pickup_borough trip_type total_trips total_passengers
        total_distance_miles avg_distance_miles total_fare avg_fare total_tips avg_tip_percentage
        avg_duration_minutes updated_at""",
    "fct_zone_metrics": """zone_id metric_date trip_type pickups dropoffs total_fare_from_zone
        avg_fare_from_zone avg_distance_from_zone avg_duration_from_zone updated_at""",
}
_KINDS = {
    "string": """trip_id trip_type store_and_fwd_flag dispatching_base_num affiliated_base_num borough
        zone_name service_zone pickup_zone_name pickup_borough pickup_service_zone dropoff_zone_name
        dropoff_borough dropoff_service_zone""",
    "int": """pickup_zone_id dropoff_zone_id passenger_count vendor_id rate_code_id payment_type
        green_trip_type zone_id""",
    "bigint": "trip_duration_minutes total_trips total_passengers pickups dropoffs",
    "double": """trip_distance fare_amount extra mta_tax improvement_surcharge tip_amount tolls_amount
        total_amount avg_speed_mph tip_percentage total_distance_miles avg_distance_miles total_fare avg_fare
        total_tips avg_tip_percentage avg_duration_minutes total_fare_from_zone avg_fare_from_zone
        avg_distance_from_zone avg_duration_from_zone""",
    "boolean": "is_shared_ride is_airport is_yellow_zone is_nyc_borough",
    "date": "trip_date metric_date",
    "timestamp_ntz": "pickup_datetime dropoff_datetime",
    "timestamp": "loaded_at updated_at",
}


def _contract_rows() -> str:
    kind_of = {column: kind for kind, columns in _KINDS.items() for column in columns.split()}
    rows = []
    for model, columns in _COLUMNS.items():
        for column in columns.split():
            kind = kind_of[column]
            filled = "*" if column in _STAMPS else column
            rows.append(
                f"select '{model}' as model, '{column}' as column_name,"
                f" '{kind}' as expected_type, '{kind}' as actual_type, 'ok' as status,"
                f" (select count({filled}) from {model}) as filled_rows"
            )
    return "\nunion all ".join(rows)


ORACLES["schema_contract"] = _from(
    _WITH_IDS.replace(" as (\n    select", " as materialized (\n    select"), _contract_rows()
)
