"""Fact tables: staging layouts, dimension lookups and incremental loads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.clean import any_of, code_label, days_between, default, holds, home_amount, per_rate
from ..functions.keys import row_hash
from ..functions.layout import Field, columns, layout, with_sources
from ..operators.control import read_watermark, since
from ..operators.documents import header_lines
from ..operators.reduce import KEY, NEAR, keep_one, near, with_key
from ..operators.temporal import asof_lookup
from ..operators.upsert import HASH, upsert
from ..sources.tables import set_table_property, table_exists, table_property

AUDIT = "dw_loaded_at"
PERIOD = "event_period"
GRAIN = "martflow.grain"
_ROW, _VERSION = "__row", "__version"

# Size of a storage partition. Frequent runs over large facts rewrite less by day.
GRAINS = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}


@dataclass(frozen=True)
class Lookup:
    """One point-in-time lookup of a surrogate key."""

    dim: str
    key: str
    dim_key: str
    take: str
    precision: str = "date"
    only: tuple[str, str] | None = None


@dataclass(frozen=True)
class Fact:
    """Grain, event date and lookups of a fact table.

    The same keys reduce the source and match the target. Columns in ``drop``
    only serve the lookups. The table is stored by the period of ``period``, or
    of the event date: a date of the key lets an upsert read its periods only.
    ``newest`` names a time that a stored row must not go back in. ``near`` names a column
    of the key that deals the rows out: rows are shuffled by it once, for their lookups,
    their reduction to one row per key and a later merge. Rows without it are dealt out by
    the columns after it, which are the event date or keys of the lookups and in the key too.
    """

    table: str
    keys: tuple[str, ...]
    event: str
    lookups: tuple[Lookup, ...]
    drop: tuple[str, ...] = ()
    watermark: tuple[str, str] | None = field(default=None)
    period: str | None = None
    newest: str | None = None
    near: tuple[str, ...] = ()


def _product(precision: str) -> Lookup:
    return Lookup("dim_product", "nk_product_id", "nk_product_id", "sk_product_id", precision)


def _salesperson(precision: str, key: str = "nk_salesperson_id") -> Lookup:
    return Lookup("dim_salesperson", key, "nk_salesperson_id", "sk_salesperson_id", precision)


def _customer(precision: str, key: str = "nk_customer_id", only=None) -> Lookup:
    return Lookup("dim_customer", key, "nk_customer_id", "sk_customer_id", precision, only)


def _supplier(precision: str, key: str = "nk_supplier_id", only=None) -> Lookup:
    return Lookup("dim_supplier", key, "nk_supplier_id", "sk_supplier_id", precision, only)


# Grain, event date, lookups and watermark of each fact.
FACTS = {
    f.table: f
    for f in (
        Fact(
            "fact_sales_invoice_header",
            ("nk_document_id", "nk_document_no", "document_creation_date"),
            "invoice_date",
            (_customer("date"), _salesperson("date")),
            ("nk_customer_id", "nk_salesperson_id"),
            ("fact_sales_invoice_header", "invoice_date"),
            period="document_creation_date",
        ),
        Fact(
            "fact_sales_invoice_lines",
            ("nk_document_id", "nk_document_no", "position_seq_no", "sk_product_id"),
            "invoice_date",
            (_product("date"),),
            ("nk_product_id",),
            ("fact_sales_invoice_header", "invoice_date"),
            near=("nk_document_id",),
        ),
        Fact(
            "fact_sales_order_header",
            (
                "nk_document_id",
                "nk_document_no",
                "sk_customer_id",
                "sk_salesperson_id",
                "transaction_date",
            ),
            "transaction_date",
            (_customer("date"), _salesperson("date")),
            ("nk_customer_id", "nk_salesperson_id"),
            ("fact_sales_order_header", "transaction_date"),
            near=("nk_document_id",),
        ),
        Fact(
            "fact_sales_order_lines",
            (
                "nk_document_id",
                "nk_document_no",
                "position_seq_no",
                "sk_product_id",
                "transaction_date",
            ),
            "transaction_date",
            (_product("date"),),
            ("nk_product_id",),
            ("fact_sales_order_header", "transaction_date"),
            near=("nk_document_id",),
        ),
        Fact(
            "fact_purchase_order_header",
            (
                "nk_document_id",
                "nk_document_no",
                "document_status",
                "sk_supplier_id",
                "sk_salesperson_id",
                "document_type_code",
                "original_document_date",
                "created_date",
            ),
            "document_created_date",
            (_salesperson("date"), _supplier("date")),
            ("nk_supplier_id", "nk_salesperson_id"),
            ("fact_purchase_order_header", "document_created_date"),
        ),
        Fact(
            "fact_purchase_order_lines",
            (
                "nk_document_id",
                "nk_document_no",
                "position_seq_no",
                "document_created_date",
                "sk_product_id",
            ),
            "document_created_date",
            (_product("timestamp"),),
            ("nk_product_id",),
            ("fact_purchase_order_header", "document_created_date"),
            near=("nk_document_id",),
        ),
        Fact(
            "fact_supplier_invoice_header",
            (
                "sk_supplier_id",
                "sk_salesperson_id",
                "nk_document_id",
                "nk_document_no",
                "invoice_date",
            ),
            "invoice_date",
            (_supplier("timestamp"), _salesperson("timestamp")),
            ("nk_supplier_id", "nk_salesperson_id"),
            ("fact_supplier_invoice_header", "invoice_date"),
        ),
        Fact(
            "fact_supplier_invoice_lines",
            ("nk_document_id", "nk_document_no", "nk_line_id", "sk_product_id", "invoice_date"),
            "invoice_date",
            (_product("timestamp"),),
            ("nk_product_id",),
            ("fact_supplier_invoice_header", "invoice_date"),
            near=("nk_document_id",),
        ),
        Fact(
            "fact_goods_receipt_lines",
            (
                "nk_document_id",
                "nk_document_no",
                "position_seq_no",
                "receipt_date",
                "sk_product_id",
                "sk_supplier_id",
            ),
            "receipt_date",
            (_supplier("timestamp"), _product("timestamp")),
            ("nk_supplier_id", "nk_product_id"),
            ("fact_goods_receipt_lines", "receipt_date"),
            near=("nk_document_id", "receipt_date"),
        ),
        Fact(
            "fact_product_prices",
            ("sk_product_id", "price_id", "price_label"),
            "updated_at",
            (_product("timestamp"),),
            ("nk_product_id",),
            ("fact_product_prices", "updated_at"),
            newest="updated_at",
        ),
        Fact(
            "fact_serial_number_event",
            (
                "nk_event_id",
                "sk_product_id",
                "warehouse",
                "house_serial_number",
                "nk_document_id",
                "created_at",
            ),
            "event_date",
            (
                _product("timestamp"),
                _customer("timestamp", "nk_party_id", ("party_type_code", "K")),
                _supplier("timestamp", "nk_party_id", ("party_type_code", "L")),
                _salesperson("date", "nk_responsible_employee_id"),
            ),
            ("nk_product_id",),
            ("fact_serial_number_event", "event_date"),
            period="created_at",
        ),
    )
}

# Tenant and cancellation filters of the sales documents.
SALES_TENANT = 1
NOT_CANCELLED = 0

# Codes of serial-number events.
PARTY_TYPES = {"Customer": ["K"], "Supplier": ["L"]}
DOCUMENT_CATEGORIES = {
    "Sales Invoice": ["F", "G", "M", "O"],
    "Sales Order": ["A", "B", "L"],
    "Purchase Order": ["E"],
    "Goods Receipt": ["W"],
    "Supplier Invoice": ["R"],
}

# Output column, source column, rule.
SALES_INVOICE_HEADER = layout("""
nk_document_id                  h.bsbelid       keep
nk_document_no                  h.bsbelnr       keep
nk_customer_id                  h.bskundennr    keep
nk_salesperson_id               h.bsbeakz       keep
nk_payment_term_id              h.bszb          keep
nk_shipping_method_id           h.bsvartnr      keep
nk_source_order_id              h.bsubelnr      keep
nk_source_order_type            h.bsubeltyp     keep
invoice_date                    h.bsdatum       date
document_creation_date          h.bsedatum      date
original_document_date          h.bsudatum      date
delivery_date                   h.bsliefdat     date
document_type_code              h.bsbeltyp      keep
document_category_code          h.bsgara        string
reference_document_indicator    h.bsbelkz       lower
collection_status_code          h.bssammstat    string
document_status                 h.bsstatkz      keep
exchange_rate                   h.bsukurs       keep
is_online                       h.bsonline      is_true
is_credit_note                  h.bsbeltyp      is_G
header_net_total                h.bsvkpreis     keep
header_gross_total              h.bsbrutto      keep
header_vat_total                h.bsmwst        keep
header_shipping_cost            h.bsversend     keep
amount_paid                     h.bsgezahlt     keep
due_date                        h.bsfaellig     timestamp
payment_date                    h.bszahldat     timestamp
is_open                         h.bsoffen       is_O
project_code                    h.bsprojekt     text
purchase_amount                 h.bsekpreis     keep
""")

# Output column, source column, rule.
SALES_INVOICE_LINES = layout("""
nk_document_id          h.bsbelid       keep
nk_document_no          h.bsbelnr       keep
invoice_date            h.bsdatum       date
position_seq_no         p.bpposnr       keep
nk_product_id           p.bpidnr        keep
warehouse               p.bplager       text
pos_mankey              p.bpmankey      keep
is_cancellation         p.bpstorno      not_blank
quantity                p.bpstueck      keep
quantity_returned       p.bpmgut        keep
unit_sales_price_net    p.bpvkpreis     keep
unit_sales_price_gross  p.bpvkbrutt     keep
unit_purchase_price     p.bpekpreis     keep
unit_purchase_price2    p.bpekpreis2    keep
unit_purchase_price_net p.bpekrein      keep
discount_pct            p.bprabatt      keep
discount_pct2           p.bprabatt2     keep
doc_discount_pct        p.bprabproz     keep
tax_rate_id             p.bpmwst        keep
currency_code           p.bpwaehrung    keep
exchange_rate_lines     p.bpukurs       keep
exchange_unit           p.bpueinh       keep
""")

# Output column, source column, rule.
SALES_ORDER_HEADER = layout("""
nk_document_id                  h.bsbelid       bigint
nk_document_no                  h.bsbelnr       bigint
nk_customer_id                  h.bskundennr    bigint
nk_salesperson_id               h.bsbeakz       bigint
transaction_date                h.bsdatum       date
document_type_code              h.bsbeltyp      string
document_category_code          h.bsgara        string
reference_document_indicator    h.bsbelkz       lower
collection_status_code          h.bssammstat    string
document_status                 h.bsstatkz      string
document_online                 h.bsonline      boolean
nk_payment_term                 h.bszb          bigint
nk_shipping_method              h.bsvartnr      bigint
nk_source_doc_id                h.bsubelnr      bigint
nk_source_doc_type              h.bsubeltyp     string
project_code                    h.bsprojekt     string_text
distributor_code                h.bsprov        string_text
""")

# Output column, source column, rule.
SALES_ORDER_LINES = layout("""
nk_document_id          h.bsbelid       bigint
nk_document_no          h.bsbelnr       bigint
position_seq_no         p.bpposnr       bigint
nk_product_id           p.bpidnr        bigint
warehouse               p.bplager       string
transaction_date        h.bsdatum       date
is_cancellation         p.bpstorno      not_blank
quantity                p.bpstueck      decimal
quantity_returned       p.bpmgut        decimal
unit_sales_price_net    p.bpvkpreis     decimal
unit_sales_price_gross  p.bpvkbrutt     decimal
unit_purchase_price     p.bpekpreis     decimal
unit_purchase_price2    p.bpekpreis2    decimal
unit_purchase_price_net p.bpekrein      decimal
discount_pct            p.bprabatt      decimal
discount_pct2           p.bprabatt2     decimal
doc_discount_pct        p.bprabproz     decimal
tax_rate_id             p.bpmwst        bigint
currency_code           p.bpwaehrung    string
exchange_rate           p.bpukurs       decimal_one
exchange_unit           p.bpueinh       decimal_one
""")

# Output column, source column, rule.
PURCHASE_ORDER_HEADER = layout("""
nk_document_id              h.lbbelid       keep
nk_document_no              h.lbbelnr       keep
document_type_code          h.lbbeltyp      keep
document_status             h.lbstatkz      keep
nk_supplier_id              h.lbliefnr      keep
nk_salesperson_id           h.lbbeakz       keep
created_date                h.lbdatum       date
document_created_date       h.lbedatum      date
original_document_date      h.lbudatum      date
completed_date              h.lberled       date
estimated_departure_date    h.lbetd         date
estimated_arrival_date      h.lbeta         date
actual_departure_date       h.lbatd         date
actual_arrival_date         h.lbata         date
amount                      h.lbbetrag      keep
purchase_price_total        h.lbekpreis     keep
total_vat                   h.lbmwst        keep
document_discount           h.lbbelrab      keep
shipping_cost               h.lbversand     keep
packaging_cost              h.lbverpack     keep
insurance_cost              h.lbversich     keep
freight_handling            h.lbfracht      keep
customs_cost                h.lbzoll        keep
internal_procurement_cost   h.lbversint     keep
total_weight                h.lbgewicht     keep
header_currency             h.lbwaehrung    keep
header_exchange_rate        h.lbukurs       keep
header_exchange_unit        h.lbueinh       keep
client_currency             h.lbmandwaeh    keep
delivery_terms              h.lbliefkond    keep
payment_terms               h.lbzb          keep
shipping_method             h.lbversart     keep
shipping_method_id          h.lbvartnr      keep
partial_delivery_allowed    h.lbteil        keep
down_payment_pct            h.lbanzproz     keep
is_blocked                  h.lbsperr       keep
answer_status               h.lbantwort     keep
header_collective_status    h.lbsammstat    keep
price_enforcement           h.lbpreislim    keep
date_enforcement            h.lbtermlim     keep
auto_email                  h.lbemauto      keep
print_groups                h.lbkodruck     keep
cancellation_editor         h.lbstbear      keep
cancellation_date           h.lbstdatum     date
cancellation_comment        h.lbstorntxt    keep
original_document_type      h.lbubeltyp     keep
original_document_no        h.lbubelnr      keep
dunning_date_1              h.lbmah1        date
dunning_date_2              h.lbmah2        date
dunning_date_3              h.lbmah3        date
dunning_block               h.lbmahnsp      keep
reference_text              h.lbtext        keep
note                        h.lbhinweis     keep
pretext                     h.lbvorsatzt    keep
additional_text             h.lbzusatzt     keep
additional_xml              h.lbzusatzxml   keep
external_reference          h.lbextref      keep
project                     h.lbprojekt     keep
project_yy                  h.lbprojyy      keep
delivery_note_no            h.lblsnr        keep
created_by_user             h.lbwsname      keep
created_by_time             h.lbwszeit      keep
branch                      h.lbfil         keep
remark_1                    h.lbbem1        keep
remark_2                    h.lbbem2        keep
remark_3                    h.lbbem3        keep
remark_4                    h.lbbem4        keep
remark_5                    h.lbbem5        keep
""")

# Output column, source column, rule.
PURCHASE_ORDER_LINES = layout("""
nk_document_id                  h.lbbelid       keep
nk_document_no                  h.lbbelnr       keep
document_created_date           h.lbedatum      date
line_id                         p.xsatzid       keep
position_seq_no                 p.lpposnr       keep
line_document_type              p.lpbeltyp      keep
line_client_id                  p.lpmankey      keep
line_supplier_id                p.lpliefnr      keep
nk_product_id                   p.lpidnr        keep
warehouse_code                  p.lplager       text
exchange_item_id                p.lptauidnr     keep
delivery_date                   p.lptermin      date
line_timestamp                  p.lptime        date
source_document_date            p.lpudatum      date
source_document_delivery_date   p.lputermin     date
line_dunning_block_date         p.lpmahnspb     date
quantity                        p.lpstueck      keep
quantity_stock                  p.lpteilst      keep
quantity_stock2                 p.lpbest2       keep
quantity_reserved_stock         p.lpresbst      keep
quantity_pre_invoiced           p.lpfakbst      keep
quantity_goods_receipt_stock    p.lpbestwe      keep
quantity_return                 p.lprueck       keep
quantity_completed_returns      p.lperled       keep
unit_purchase_price             p.lpekpreis     keep
unit_purchase_price2            p.lpek2we       keep
unit_purchase_price_foreign     p.lpekwae       keep
calc_purchase_price             p.lpkalkek      keep
line_vat_rate                   p.lpmwst        keep
line_document_discount          p.lpbelrab      keep
line_currency                   p.lpwaehrung    keep
line_exchange_rate              p.lpukurs       one
line_exchange_unit              p.lpueinh       one
line_client_currency            p.lpmandwaeh    keep
source_currency                 p.lpurwae       keep
source_exchange_rate            p.lpurkurs      keep
source_exchange_unit            p.lpureinh      keep
surcharge0                      p.lpaufschl0    zero
surcharge1                      p.lpaufschl1    zero
surcharge2                      p.lpaufschl2    zero
surcharge3                      p.lpaufschl3    zero
customs_pct                     p.lpzoll        zero
freight_pct                     p.lpfracht      zero
line_shipping                   p.lpversand     zero
line_packaging                  p.lpverpack     zero
line_insurance                  p.lpversich     zero
line_internal_procurement_cost  p.lpversint     zero
bonus                           p.lpbonus       zero
manufacturer_discount           p.lprablag      zero
goods_receipt_surcharge         p.lpwezuschl    zero
ear_costs                       p.lpearkost     zero
line_dunning_date_1             p.lpmahn1       date
line_dunning_date_2             p.lpmahn2       date
line_dunning_date_3             p.lpmahn3       date
line_dunning_block              p.lpmahnsp      keep
dunning_level                   p.lpmahnnr      keep
dunning_date                    p.lpmahndat     date
dunning_quantity                p.lpmahnmg      keep
line_source_document_type       p.lpubeltyp     keep
line_source_document_no         p.lpubelnr      keep
line_source_position_no         p.lpuposnr      keep
line_source_delivery_date_type  p.lputermart    keep
customer_document_type          p.lpkdbeltyp    keep
customer_document_no            p.lpkdbelnr     keep
customer_document_customer_no   p.lpkdnummer    keep
customer_document_position_no   p.lpkdposnr     keep
customer_document_no2           p.lpkdbelman    keep
customer_document_client_id     p.lpkdmankey    keep
stock_assignment                p.lpbestand     keep
component_flag                  p.lpgrund       keep
distributor                     p.lpdistrib     text
distributor_order_no            p.lpbestnr      text
rma_no                          p.lprmanr       keep
delivery_date_type              p.lptermart     keep
line_collective_status          p.lpsammstat    keep
reservation_direct              p.lpresdir      keep
additional_description          p.lpzusben      keep
line_additional_text            p.lpzusatzt     keep
line_additional_xml             p.lpzusatzxml   keep
hint_sales                      p.lphinwavk     keep
old_position_no                 p.lpposalt      keep
position_uuid                   p.lpposid       keep
contract_warehouse              p.lpvertlag     keep
""")

# Output column, source column, rule.
SUPPLIER_INVOICE_HEADER = layout("""
nk_document_id          h.lrbelid       keep
nk_document_no          h.lrbelegnr     keep
document_type           h.lrbelegtyp    keep
nk_supplier_id          h.lrliefnr      keep
nk_salesperson_id       h.lrbeakz       keep
internal_document_no    h.lrintbelnr    keep
invoice_date            h.lrdatum       date
entry_date              h.lreingabe     date
due_date                h.lrfaellig     date
payment_date            h.lrzahldat     date
vat_date                h.lrustdatum    date
cancellation_date       h.lrstdatum     date
export_date             h.lrexpdat      date
amount_gross            h.lrbrutto      zero
amount_net              h.lrnetto       zero
total_vat               h.lrmwst        zero
shipping_cost           h.lrversend     zero
packaging_cost          h.lrverpack     zero
insurance_cost          h.lrversich     zero
amount_paid             h.lrgezahlt     zero
payment_amount          h.lrzahlung     zero
is_open                 h.lroffen       is_J
is_cancelled            h.lrstbear      positive
payment_block           h.lropk         text
payment_method          h.lrzahlkenn    keep
cash_discount_days      h.lrsktage      zero
cash_discount_pct       h.lrskproz      zero
currency_code           h.lrwaehrung    eur
exchange_rate           h.lrukurs       one
exchange_unit           h.lrueinh       one
client_currency         h.lrmandwaeh    eur
reference_text          h.lrtext        text
remark                  h.lrbem         text
note                    h.lrhinweis     text
project                 h.lrprojekt     text
branch                  h.lrfil         text
payables_account        h.lrkrekto      keep
cancellation_editor     h.lrstbear      keep
""")

# Output column, source column, rule.
SUPPLIER_INVOICE_LINES = layout("""
nk_line_id          p.xsatzid       keep
nk_document_id      h.lrbelid       keep
nk_document_no      h.lrbelegnr     keep
position_seq_no     p.lrwposnr      keep
nk_product_id       p.lrwidnr       keep
goods_receipt_no    p.lrwbelnr      keep
goods_receipt_type  p.lrwbeltyp     text
line_status         p.lrwstatkz     text
quantity_billed     p.lrwstueck     zero
unit_price          p.lrwlfpreis    zero
currency_code       h.lrwaehrung    eur
exchange_rate       h.lrukurs       one
exchange_unit       h.lrueinh       one
is_cancelled        h.lrstbear      positive
document_type       h.lrbelegtyp    keep
invoice_date        h.lrdatum       date
""")

# Output column, source column, rule.
GOODS_RECEIPT = layout("""
nk_receipt_id               lpid        keep
nk_document_id              lpbelid     keep
nk_document_no              lpbelnr     keep
position_seq_no             lpposnr     keep
nk_supplier_id              lpliefnr    keep
nk_product_id               lpidnr      keep
warehouse                   lplager     text
receipt_date                lpdatum     date
expiry_date                 lpedat      date
best_before_date            lpmhdatum   date
receipt_status              lpstatus    keep
stock_type                  lpwekey     text
quantity_received           lpmgist     zero
quantity_expected           lpmgsoll    zero
is_defective                lpdefekt    bool
serial_number               lpsernr     text
house_serial_number         lphaunr     text
package_no                  lppaketnr   text
position_uuid               lpposid     text
container_id                lpcontid    text
serial_addition_1           lpserz1     text
serial_addition_2           lpserz2     text
warranty_code               lpgarkenn   text
warranty_months             lpgarmon    zero
extended_warranty_months    lpergmon    zero
extended_warranty_code      lpergkenn   text
supplier_warranty_months    lplfgmon    zero
supplier_warranty_code      lplfgkenn   text
source_document_no          lpubelnr    keep
source_document_type        lpubeltyp   text
delivery_note_no            lplbeleg    text
receipt_remark              lpwebem     text
goods_receipt_no            lpwenr      text
storage_location            lplago1     text
created_by_user             lpwsname    keep
""")

# Output column, source column, rule.
PRODUCT_PRICE = layout("""
nk_product_id           p.anidnr        keep
currency                p.anwaehrung    eur
price_id                p.anpid         keep
price_label             vp.aapbez       text
price_group_desc        vp.aapbem       text
is_gross_calc           vp.aapbrucalc   bool
min_gross_profit_pct    vp.aapwarnroh   zero
max_discount_pct        vp.aapmaxnach   zero
price_net               p.anvkpreis     zero
price_gross             p.anvkbrutt     zero
calc_pct                p.anvkproz      zero
allow_zero_price        p.anprnull      positive
price_min_max_gross     p.anminmaxbr    positive
price_min               p.anprmin       zero
price_max               p.anprmax       zero
recommended_price       w.awempfvk      keep
no_rounding             w.awkeinrund    keep
component_price_min     w.awprmin       keep
component_price_max     w.awprmax       keep
cost_procurement        w.awkoeink      keep
cost_procurement_is_pct w.awkoeinkpr    keep
cost_handling           w.awkohand      keep
cost_handling_is_pct    w.awkohandpr    keep
cost_testing            w.awkotest      keep
cost_testing_is_pct     w.awkotestpr    keep
cost_overhead           w.awkokost      keep
cost_overhead_is_pct    w.awkokostpr    keep
formula_type            w.awformel      keep
formula_x               w.awformelx     keep
formula_y               w.awformely     keep
shipping_cost_type      w.awovsandtp    keep
shipping_cost_amt       w.awovsandwt    keep
gema_type               w.awgematyp     keep
gema_value              w.awgemawert    keep
warranty_calc_item      w.awgarkalk     text
updated_at              p.updtime       timestamp
""")
TIERS = range(1, 11)
PRICE_TIERS = tuple(
    tier
    for i in TIERS
    for tier in (
        Field(f"tier_price_net_{i}", f"p.anvkstne{i}", "zero"),
        Field(f"tier_price_gross_{i}", f"p.anvkstbr{i}", "zero"),
        Field(f"tier_qty_{i}", f"w.awvkstaf{i}", "keep"),
    )
)

# Output column, source column, rule.
SERIAL_EVENT = layout("""
nk_event_id                 seserid     keep
nk_product_id               seidnr      keep
warehouse                   selager     text
serial_number               sesernr     text
house_serial_number         sehaunr     text
quantity                    seserac     keep
is_batch                    sechargen   keep
is_outbound                 seaus       keep
party_type_code             sekltyp     text
nk_party_id                 sekdnummer  keep
nk_document_id              sebelid     keep
document_type_code          sebeltyp    text
document_no                 sebelnr     keep
position_no                 seposnr     keep
event_date                  sedatum     date
created_at                  seekredat   date
best_before_date            semhdatum   date
warranty_expiry_date        selfgadat   date
cancellation_date           sestdatum   date
warranty_code               segarkenn   text
warranty_months             segarmon    zero
extended_warranty_code      seergkenn   text
extended_warranty_months    seergmon    zero
supplier_warranty_code      selfgkenn   text
supplier_warranty_months    selfgmon    zero
is_cancelled                sestorno    is_J
cancellation_editor         sestbear    keep
error_code                  sekztext    text
error_text                  setext      text
delivery_note_no            selbeleg    text
nk_responsible_employee_id  sebea       keep
is_external                 sefremd     keep
remark_1                    sebem1      text
remark_2                    sebem2      text
serial_addition_1           seserz1     text
serial_addition_2           seserz2     text
""")


def _as(df: DataFrame, alias: str, *layouts: tuple[Field, ...]) -> DataFrame:
    """Alias a source that has the columns of the layouts."""
    for fields in layouts:
        df = with_sources(df, fields, f"{alias}.")
    return df.alias(alias)


def stage_sales_invoice(
    headers: DataFrame, lines: DataFrame, extras: DataFrame, watermark: dt.date | None = None
) -> tuple[DataFrame, DataFrame]:
    """Sales invoices at header grain and at line grain."""
    open_headers = headers.where(
        (F.col("bsmankey") == SALES_TENANT) & (F.col("bsstbear") == NOT_CANCELLED)
    )
    h = _as(since(open_headers, "bsdatum", watermark), "h", SALES_INVOICE_HEADER)
    quantity = F.col("p.bpstueck")
    line_columns = [
        *columns(SALES_INVOICE_LINES),
        (quantity * F.col("p.bpvkpreis")).alias("line_net_amount"),
        (quantity * F.col("p.bpvkbrutt")).alias("line_gross_amount"),
        (quantity * F.col("p.bpekpreis")).alias("line_purchase_amount"),
    ]
    p = _as(lines, "p", SALES_INVOICE_LINES)
    grain, line = header_lines(h, p, [("h.bsbelid", "p.bpbelid")], line_columns)

    net = per_rate(F.col("h.bsvkpreis").cast("decimal(38,6)"), "h.bsukurs")
    costs = F.col("h.bsekpreis2") + F.col("h.bsgema") + F.col("h.bskoop")
    shipping = (
        F.col("h.bsversend") + F.col("h.bsverpack") + F.col("h.bsmaut") - F.col("h.bsintkostv")
    )
    header = grain.select(
        *columns(SALES_INVOICE_HEADER),
        days_between("h.bsdatum", "h.bszahldat").alias("days_to_pay"),
        net.alias("revenue"),
        costs.alias("cost_amount"),
        shipping.alias("shipping_amount"),
    )
    channels = extras.select(
        F.col("k2pbelid").alias("__document"),
        F.col("k2pposnr").alias("__position"),
        F.lower(F.trim("k2pfrei1")).alias("business_channel"),
    )
    same_line = (F.col("nk_document_id") == F.col("__document")) & (
        F.col("position_seq_no") == F.col("__position")
    )
    return header, line.join(channels, same_line, "left").drop("__document", "__position")


def stage_sales_order(
    headers: DataFrame, lines: DataFrame, watermark: dt.date | None = None
) -> tuple[DataFrame, DataFrame]:
    """Sales orders that have lines, at header grain and at line grain."""
    open_headers = headers.where(
        (F.col("bsmankey") == SALES_TENANT) & (F.col("bsstbear") == NOT_CANCELLED)
    )
    h = _as(since(open_headers, "bsdatum", watermark), "h", SALES_ORDER_HEADER)
    p = _as(lines, "p", SALES_ORDER_LINES)
    grain, line = header_lines(
        h, p, [("h.bsbelid", "p.bpbelid")], columns(SALES_ORDER_LINES), "inner"
    )
    net = per_rate(F.col("h.bsvkpreis").cast("decimal(38,6)"), "h.bsukurs")
    costs = F.col("h.bsekpreis2") + F.col("h.bsgema") + F.col("h.bskoop")
    header = grain.select(
        *columns(SALES_ORDER_HEADER),
        net.alias("revenue"),
        costs.cast("decimal(38,7)").alias("cost_amount"),
    )
    return header, line


def stage_purchase_order(
    headers: DataFrame, lines: DataFrame, watermark: dt.date | None = None
) -> tuple[DataFrame, DataFrame]:
    """Purchase orders at header grain and at line grain."""
    h = _as(since(headers, "lbedatum", watermark), "h", PURCHASE_ORDER_HEADER)
    p = _as(lines, "p", PURCHASE_ORDER_LINES)
    amount = F.col("p.lpstueck") * F.col("p.lpekpreis")
    line_columns = [
        *columns(PURCHASE_ORDER_LINES),
        amount.alias("line_purchase_amount"),
        home_amount("p.lpstueck", "p.lpekpreis", "p.lpukurs", "p.lpueinh").alias("line_purchase_eur"),
        days_between("h.lbdatum", "p.lptermin").alias("delivery_time_days"),
    ]
    grain, line = header_lines(h, p, [("h.lbbelid", "p.lpbelid")], line_columns)
    return grain.select(*columns(PURCHASE_ORDER_HEADER)), line


def stage_supplier_invoice(
    headers: DataFrame, lines: DataFrame, watermark: dt.date | None = None
) -> tuple[DataFrame, DataFrame]:
    """Supplier invoices at header grain and at line grain."""
    h = _as(since(headers, "lrdatum", watermark), "h", SUPPLIER_INVOICE_HEADER)
    p = _as(lines, "p", SUPPLIER_INVOICE_LINES)
    amount = default("p.lrwstueck", 0) * default("p.lrwlfpreis", 0)
    line_columns = [*columns(SUPPLIER_INVOICE_LINES), amount.alias("line_amount")]
    grain, line = header_lines(h, p, [("h.lrbelid", "p.lrwbelid")], line_columns)
    return grain.select(*columns(SUPPLIER_INVOICE_HEADER)), line


def stage_goods_receipt(receipts: DataFrame, watermark: dt.date | None = None) -> DataFrame:
    source = with_sources(since(receipts, "lpdatum", watermark), GOODS_RECEIPT)
    defective = F.when(default("lpdefekt", False), default("lpmgist", 0)).otherwise(F.lit(0))
    return source.select(*columns(GOODS_RECEIPT), defective.alias("quantity_defective"))


def stage_product_prices(
    prices: DataFrame, parameters: DataFrame, groups: DataFrame, watermark: dt.date | None = None
) -> DataFrame:
    """Prices with their currency parameters and price-group labels.

    The parameters come last and are joined by the product alone, of which each has a few
    rows for its tenants and currencies. So the wide prices are shuffled by product once,
    for them and for the look-up of the product.
    """
    p = _as(since(prices, "updtime", watermark), "p", PRODUCT_PRICE, PRICE_TIERS)
    w = _as(parameters, "w", PRODUCT_PRICE, PRICE_TIERS)
    vp = _as(groups, "vp", PRODUCT_PRICE)
    of_group = (F.col("p.anpid") == F.col("vp.aapid")) & (F.col("p.anmankey") == F.col("vp.aamankey"))
    of_product = (
        (F.col("p.anidnr") == F.col("w.awidnr"))
        & holds(F.col("p.anmankey") == F.col("w.awmankey"))
        & holds(F.col("p.anwaehrung") == F.col("w.awwaehrung"))
    )
    joined = p.join(vp, of_group, "left").join(w, of_product, "left")
    return joined.select(*columns(PRODUCT_PRICE), *columns(PRICE_TIERS))


def stage_serial_events(events: DataFrame, watermark: dt.date | None = None) -> DataFrame:
    source = with_sources(since(events, "sedatum", watermark), SERIAL_EVENT)
    return source.select(
        *columns(SERIAL_EVENT),
        F.when(F.col("seaus"), "OUT").otherwise("IN").alias("movement_direction"),
        code_label("sekltyp", PARTY_TYPES, "Unknown").alias("party_type"),
        code_label("sebeltyp", DOCUMENT_CATEGORIES, "Other").alias("document_category"),
    )


def look_up(fact: Fact, rows: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Add the surrogate keys that were valid on the event date.

    With ``near``, only what the lookups need is shuffled to the dimensions, each
    combination once. The versions found are dealt out like the rows and spread over them by
    a window, which takes rows that are together as they are. The source is read twice.
    """
    if not fact.near:
        return _versions(fact, rows, dims).drop(*fact.drop)
    return _near_versions(fact, rows, dims).drop(NEAR, *fact.drop)


def _near_versions(fact: Fact, rows: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The rows with their versions, dealt out by the column ``NEAR``."""
    needed = [fact.near[0], fact.event, *[c for l in fact.lookups for c in (l.key, *(l.only or ())[:1])]]
    needed = list(dict.fromkeys(needed))
    dealt = near(fact.near[0], rows.schema[fact.near[0]].dataType, *fact.near[1:])
    asked = rows.where(any_of([F.col(l.key).isNotNull() for l in fact.lookups])).select(*needed)
    asked = asked.withColumn(NEAR, dealt).distinct().drop(NEAR)
    version = F.struct(*[l.take for l in fact.lookups]).alias(_VERSION)
    found = _versions(fact, asked, dims).select(*needed, version).repartition(dealt)
    # The needed columns move into a struct: a union keeps a partitioning that has one name.
    group = [dealt.alias(NEAR), F.struct(*needed).alias(KEY)]
    rest = [c for c in rows.columns if c not in needed]
    mine = rows.repartition(dealt).select(*group, *rest, F.lit(True).alias(_ROW))
    both = found.select(*group, _VERSION).unionByName(mine, allowMissingColumns=True)
    versions = F.collect_list(_VERSION).over(Window.partitionBy(NEAR, KEY))
    spread = both.withColumn(_VERSION, versions).where(_ROW)
    spread = spread.withColumn(_VERSION, F.explode_outer(_VERSION))
    own = [F.col(f"{KEY}.{c}") if c in needed else F.col(c) for c in rows.columns]
    return spread.select(NEAR, *own, f"{_VERSION}.*")


def _versions(fact: Fact, rows: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    for l in fact.lookups:
        rows = asof_lookup(
            rows,
            dims[l.dim],
            [(l.key, l.dim_key)],
            fact.event,
            [l.take],
            precision=l.precision,
            only=None if l.only is None else F.col(l.only[0]) == l.only[1],
        )
    return rows


def build_fact(
    fact: Fact,
    rows: DataFrame,
    dims: Mapping[str, DataFrame],
    loaded_at: Column | None = None,
    hash_first: bool = False,
) -> DataFrame:
    """Surrogate keys, change hash, one row per key, and the load time.

    The hash covers every column outside the key except the load time. Of rows
    with equal keys the one of the latest event stays, and of equally late ones
    that with the smallest hash.

    ``hash_first`` suits callers that take few columns: where no looked-up key is
    hashed, the hash comes before the lookups, which then shuffle those few columns
    and the hash. A caller that takes all columns would only shuffle the hash more.
    """
    moment = F.current_timestamp() if loaded_at is None else loaded_at
    hashed = _hashed(fact, rows, dims, hash_first)
    kept = keep_one(hashed, [*_dealt(fact), *fact.keys], _latest(fact))
    return kept.drop(*_dealt(fact)).withColumn(AUDIT, moment)


def _dealt(fact: Fact) -> list[str]:
    return [NEAR] if fact.near else []


def _hashed(
    fact: Fact, rows: DataFrame, dims: Mapping[str, DataFrame], hash_first: bool = False
) -> DataFrame:
    """The rows with surrogate keys and hash, and with ``NEAR`` where the fact has it."""
    find = _near_versions if fact.near else _versions
    keyed = find(fact, rows, dims).drop(*fact.drop)
    compared = [c for c in keyed.columns if c not in (NEAR, *fact.keys)]
    if hash_first and set(compared) <= set(rows.columns):
        before = find(fact, rows.withColumn(HASH, row_hash(compared)), dims)
        return before.select(*keyed.columns, HASH)
    return keyed.withColumn(HASH, row_hash(compared))


def _latest(fact: Fact) -> list[Column | str]:
    return [F.col(fact.newest or fact.event).desc(), HASH]


def load_fact(
    spark: SparkSession,
    schema: str,
    fact: Fact,
    rows: DataFrame,
    dims: Mapping[str, DataFrame],
    loaded_at: Column | None = None,
    grain: str | None = None,
) -> None:
    """Upsert staged rows into the stored fact, partitioned by period.

    The grain of the first load ("month", if none is given) is a property of the
    table. Later loads follow it; another one is an error. Where the first load was
    lost before it wrote the property, the stored periods tell the grain. A key
    without the date gets an index, so that no load reads the keys of all periods.

    With the date in the key, a later load is reduced by the key struct it is merged by,
    which takes one shuffle; the periods to read come from the staged dates.
    """
    table = f"{schema}.{fact.table}"
    exists = table_exists(spark, table)
    stored = table_property(spark, table, GRAIN) if exists else None
    written = stored or (_grain_of_periods(spark, table) if exists else None)
    if stored is None and written is not None:
        set_table_property(spark, table, GRAIN, written)
        stored = written
    if stored and grain and grain != stored:
        raise ValueError(f"{table} is stored by {stored}, not by {grain}")
    grain = stored or grain or "month"
    date = fact.period or fact.event
    period = F.date_format(date, GRAINS[grain])
    # The period follows from a date of the key, so it may join the key and prune.
    keys = [*fact.keys, PERIOD] if date in fact.keys else list(fact.keys)
    touching = None
    if exists and date in fact.keys and date in rows.columns:
        hashed = _hashed(fact, rows, dims).withColumn(PERIOD, period)
        kinds = spark.read.table(table).schema
        if all(hashed.schema[k].dataType == kinds[k].dataType for k in keys):
            touching = rows.select(period.alias(PERIOD))
    if touching is None:
        built = build_fact(fact, rows, dims, loaded_at).withColumn(PERIOD, period)
    else:
        moment = F.current_timestamp() if loaded_at is None else loaded_at
        built = keep_one(with_key(hashed, keys), [*_dealt(fact), KEY], _latest(fact)).withColumn(AUDIT, moment)
    upsert(
        spark,
        table,
        built,
        keys,
        partition_by=[PERIOD],
        newest=fact.newest,
        key_index=True,
        keep_maxima=watermark_columns(fact),
        reduced=True,
        touching=touching,
        near_by=fact.near,
    )
    if stored is None:
        set_table_property(spark, table, GRAIN, grain)


def _grain_of_periods(spark: SparkSession, table: str) -> str | None:
    """The grain whose format the stored periods have; None without periods."""
    shown = spark.sql(f"SHOW PARTITIONS {table}").where(F.col("partition").rlike("=[0-9]"))
    first = shown.first()
    if first is None:
        return None
    lengths = {len(pattern): name for name, pattern in GRAINS.items()}
    return lengths[len(first[0].rpartition("=")[2])]


def run_fact(
    spark: SparkSession,
    schema: str,
    fact: Fact,
    stage: Callable[[dt.date | None], DataFrame],
    dims: Mapping[str, DataFrame],
    control: DataFrame,
    loaded_at: Column | None = None,
    grain: str | None = None,
) -> None:
    """One incremental run: stage the rows since the watermark and upsert them."""
    load_fact(spark, schema, fact, stage(watermark_of(fact, control)), dims, loaded_at, grain)


def run_document(
    spark: SparkSession,
    schema: str,
    header: Fact,
    lines: Fact,
    stage: Callable[[dt.date | None], tuple[DataFrame, DataFrame]],
    dims: Mapping[str, DataFrame],
    control: DataFrame,
    loaded_at: Column | None = None,
    grain: str | None = None,
) -> None:
    """One incremental run of a document: header fact, then line fact."""
    grains = stage(watermark_of(header, control))
    for fact, rows in zip((header, lines), grains):
        load_fact(spark, schema, fact, rows, dims, loaded_at, grain)


def watermark_columns(fact: Fact) -> list[str]:
    """The dates of a fact that some watermark follows."""
    followed = [f.watermark[1] for f in FACTS.values() if f.watermark and f.watermark[0] == fact.table]
    return sorted({fact.event, *followed})


def watermark_of(fact: Fact, control: DataFrame) -> dt.date | None:
    return None if fact.watermark is None else read_watermark(control, *fact.watermark)
