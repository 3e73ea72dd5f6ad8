"""Declarative description of the 64 output tables.

Column notation: ``name`` stays text, ``name:long`` / ``name:double`` /
``name:boolean`` are coerced (O6 / O7 / O8), ``^name`` is copied from the
parent table's surviving row (already typed there).

A table reads the frame at ``path`` of its export.  With a ``parent`` it keeps
only elements whose parent row survived (children explode from the
de-duplicated parent) and takes ``^`` columns from that row.  Then: row
filters on raw text, text transforms, coercion, NULL-key drop, keep-first.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    name: str
    source: str                      # export name (registry key)
    path: str                        # nesting path inside the document ("" = root)
    cols: str                        # column notation, see module doc
    parent: str | None = None        # table whose surviving rows feed this one
    active: bool = False             # O1/O2: state == 'A' (state read from this path)
    active_or_blank: bool = False    # O3
    truthy: tuple[str, ...] = ()     # O4 on raw text
    strip: tuple[str, ...] = ()      # O16
    blank_null: tuple[str, ...] = () # O17
    strip_truthy: tuple[str, ...] = ()  # strip when present, else NULL
    upper: tuple[str, ...] = ()      # O18
    default_blank: tuple[str, ...] = ()  # O21
    dropna: tuple[str, ...] = ()     # O11
    key: tuple[str, ...] | None = None   # O9 keep-first key; None = no dedup
    distinct: bool = False           # O10 whole-row dedup
    label: bool = False              # O19 inventory kind label (after dedup)
    first_of: tuple[str, str] | None = None  # O15: (child path, field) first element
    hidden: bool = False             # internal helper table, not an output

    # -- parsed column notation ------------------------------------------------
    @property
    def columns(self) -> list[str]:
        return [c.lstrip("^").split(":")[0] for c in self.cols.split()]

    @property
    def inherited(self) -> list[str]:
        return [c[1:].split(":")[0] for c in self.cols.split() if c.startswith("^")]

    @property
    def own(self) -> list[str]:
        return [c.split(":")[0] for c in self.cols.split() if not c.startswith("^")]

    def typed(self, kind: str) -> list[str]:
        return [c.split(":")[0] for c in self.cols.split()
                if not c.startswith("^") and c.endswith(":" + kind)]

    @property
    def read_fields(self) -> list[str]:
        """Raw fields this table reads from its own frame."""
        f = list(self.own)
        if (self.active or self.active_or_blank) and "state" not in f:
            f.append("state")
        return f


S = TableSpec

# The column lists, keys, filters and job groups below must equal
# those of the existing tables and schedules.

# Products line shared by order gifts / actions.
_LINE = ("external_id product_unit_id:long product_code product_local_code product_name "
         "serial_number expiry_date order_quant:double sold_quant:double return_quant:double "
         "inventory_kind on_balance card_code warehouse_code")

SPECS: list[TableSpec] = [
    # ---------------------------------------------------------------- references
    S("products", "products", "",
      "product_id:long code name short_name weight_netto:double weight_brutto:double "
      "litr:double box_type_code box_quant:double producer_code measure_code order_no:double "
      "article_code barcodes gtin ikpu tnved marking_group_code",
      active=True, key=("product_id",)),
    S("product_group", "products", "groups",
      "^product_id group_id:long group_code type_id:long type_code", parent="products",
      dropna=("product_id", "group_id", "type_id"), key=("product_id", "group_id", "type_id")),
    S("product_inventory_kind", "products", "inventory_kinds",
      "^product_id inventory_kind", parent="products",
      truthy=("inventory_kind",), upper=("inventory_kind",),
      key=("product_id", "inventory_kind"), label=True),
    S("product_sector", "products", "sector_codes",
      "^product_id sector_code", parent="products",
      truthy=("sector_code",), strip=("sector_code",), key=("product_id", "sector_code")),
    S("natural_persons", "natural_person", "",
      "person_id:long first_name last_name middle_name code birthday gender region_name "
      "region_code address post_address is_budgetarian:boolean state legal_person_code web "
      "telegram is_client:boolean is_supplier:boolean main_phone email latlng",
      active=True, key=("person_id",)),
    S("person_group", "natural_person", "groups",
      "^person_id group_code type_code", parent="natural_persons",
      truthy=("group_code",), strip=("group_code",), strip_truthy=("type_code",),
      dropna=("person_id",), key=("person_id", "group_code")),
    S("person_room", "natural_person", "rooms",
      "^person_id room_id:long room_code room_type_code", parent="natural_persons",
      truthy=("room_id",), dropna=("person_id", "room_id"), key=("person_id", "room_id")),
    S("services", "services", "",
      "service_id:long code name short_name measure_code state order_no:double",
      active=True, key=("service_id",)),
    S("service_group", "services", "groups",
      "^service_id group_code type_code", parent="services",
      truthy=("group_code",), strip=("group_code",), blank_null=("type_code",),
      dropna=("service_id",), key=("service_id", "group_code")),
    S("product_groups", "product_group", "",
      "product_group_id:long code name product_kind state",
      active=True, key=("product_group_id",)),
    S("product_group_types", "product_group", "product_group_types",
      "^product_group_id code name order_no:double", parent="product_groups",
      active=True, dropna=("product_group_id", "code"), key=("product_group_id", "code")),
    S("price_types", "price_type", "",
      "code name short_name with_card:boolean state price_type_kind currency_code",
      active=True, key=("code",)),
    S("inventory_prices", "inventory_price", "",
      "inventory_code inventory_barcode", key=("inventory_code",)),
    S("inventory_price_detail", "inventory_price", "price_type",
      "^inventory_code price_type_code card_code price:double", parent="inventory_prices",
      truthy=("price_type_code",), strip=("price_type_code",),
      dropna=("inventory_code", "price_type_code"),
      key=("inventory_code", "price_type_code", "card_code")),
    S("producers", "producers", "",
      "code person_code state order_no:double", active=True, key=("code",)),
    S("legal_entities", "legal_entity", "",
      "person_id:long name code short_name region_code is_budgetarian:boolean tin state "
      "primary_person_code parent_person_code barcode vat_code cea main_phone email web "
      "address address_guide zip_code latlng is_client:boolean is_supplier:boolean",
      active=True, key=("person_id",)),
    S("legal_entity_group", "legal_entity", "groups",
      "^person_id group_code type_code", parent="legal_entities",
      truthy=("group_code",), strip=("group_code",), blank_null=("type_code",),
      dropna=("person_id",), key=("person_id", "group_code")),
    S("legal_entity_bank_account", "legal_entity", "bank_accounts",
      "^person_id bank_account_id:long bank_account_code bank_account_name is_main:boolean "
      "currency_code state note mfo bank_name", parent="legal_entities",
      active_or_blank=True, truthy=("bank_account_id",),
      dropna=("person_id", "bank_account_id"), key=("person_id", "bank_account_id")),
    S("legal_entity_room", "legal_entity", "rooms",
      "^person_id room_id:long room_code room_type_code", parent="legal_entities",
      truthy=("room_id",), dropna=("person_id", "room_id"), key=("person_id", "room_id")),
    S("person_groups", "person_group", "",
      "person_group_id:long code name person_kind state",
      active=True, key=("person_group_id",)),
    S("person_group_types", "person_group", "person_group_types",
      "^person_group_id code name order_no:double", parent="person_groups",
      active=True, dropna=("person_group_id", "code"), key=("person_group_id", "code")),
    S("workspaces", "workspaces", "",
      "room_id:long room_code filial_code room_name room_type_code state order_no:double",
      active=True, key=("room_id",)),
    S("contracts", "contracts", "",
      "contract_id:long filial_code code contract_date contract_number name person_code "
      "currency_code expiry_date note initial_amount initial_expiry_date state is_main",
      active=True, key=("contract_id",)),
    S("sub_contracts", "contracts", "sub_contracts",
      "^contract_id sub_contract_id:long sub_contract_date sub_contract_number amount expiry_date",
      parent="contracts", key=("contract_id", "sub_contract_id")),
    S("return_reasons", "return_reason", "",
      "return_reason_id:long code name state order_no:double",
      active=True, key=("return_reason_id",)),
    # --------------------------------------------------------------------- sales
    S("orders", "order", "",
      "filial_code external_id deal_id:long invoice_external_id subfilial_code deal_time "
      "delivery_number delivery_date booked_date total_amount:double room_id:long room_code "
      "room_name robot_code lap_code sales_manager_id:long sales_manager_code "
      "sales_manager_name expeditor_id:long expeditor_code expeditor_name person_id:long "
      "person_code person_name person_local_code person_latitude person_longitude person_tin "
      "currency_code owner_person_code manager_code van_code contract_code contract_number "
      "invoice_number payment_type_code deal_margin_kind deal_margin_value:double "
      "visit_payment_type_code note deal_note status with_marking:boolean "
      "self_shipment:boolean delivery_address_short delivery_address_full "
      "marking_attaching_method visit_id:long total_weight_netto:double "
      "total_weight_brutto:double total_litre:double",
      key=("deal_id",)),
    S("order_products", "order", "order_products",
      "^deal_id external_id product_unit_id:long product_code product_local_code "
      "product_name serial_number expiry_date order_quant:double sold_quant:double "
      "return_quant:double inventory_kind on_balance card_code warehouse_code "
      "product_price:double margin_amount:double margin_value:double margin_kind "
      "vat_amount:double vat_percent:double sold_amount:double price_type_code "
      "price_type_id:long", parent="orders",
      key=("deal_id", "product_unit_id", "external_id")),
    S("order_product_details", "order", "order_products.details",
      "^deal_id ^product_unit_id expiry_date card_code batch_number sold_quant:double",
      parent="order_products"),
    S("order_product_action_margins", "order", "order_products.action_margins",
      "^deal_id ^product_unit_id bonus_calc_level bonus_id:long margin_value:double "
      "margin_kind action_name", parent="order_products"),
    S("order_gifts", "order", "order_gifts", "^deal_id " + _LINE, parent="orders"),
    S("order_actions", "order", "order_actions",
      "^deal_id " + _LINE + " bonus_id action_name", parent="orders"),
    S("order_consignments", "order", "order_consignments",
      "^deal_id external_id consignment_unit_id:long consignment_date consignment_amount:double",
      parent="orders"),
    S("returns", "returns", "",
      "filial_code external_id deal_id:long deal_time subfilial_code order_deal_id:long "
      "delivery_date delivery_number booked_date room_id:long room_code robot_code "
      "sales_manager_code sales_manager_name expeditor_code person_code person_id:long "
      "person_name person_tin owner_person_code van_code contract_code invoice_number "
      "batch_number payment_type_code note manager_code total_amount:double status "
      "return_reason_id:long return_reason_code currency_code",
      key=("deal_id",)),
    S("return_products", "returns", "return_products",
      "^deal_id external_id product_unit_id:long product_code product_name expiry_date "
      "on_balance return_quant:double serial_number product_price:double "
      "margin_amount:double margin_kind margin_value:double card_code vat_percent:double "
      "vat_amount:double sold_amount:double inventory_kind price_type_code warehouse_code",
      parent="returns", key=("deal_id", "product_unit_id", "external_id")),
    # visits: no filter, no de-duplication; ids come from the block / parent element
    S("visit_blocks", "visit", "", "visit_id:long note",
      first_of=("visit_headers", "visit_id"), default_blank=("note",), hidden=True),
    S("visits", "visit", "visit_headers",
      "visit_id:long filial_code visit_date visit_start_time visit_end_time "
      "time_at_retail_outlet_sec:double person_name person_code person_id:long room_id:long "
      "room_name room_code supervisor_id:long sales_manager_id:long sales_manager_name "
      "sales_manager_code visit_start_location visit_end_location is_planned visit_status ^note",
      parent="visit_blocks"),
    S("visit_person_types", "visit", "visit_headers.person_types",
      "^visit_id person_type_id:long person_type_name", parent="visits"),
    S("visit_stocks", "visit", "stocks",
      "^visit_id stock_product_code stock_quant:double stock_expiry_date stock_card_code",
      parent="visit_blocks"),
    S("visit_merchandisings", "visit", "merchandisings",
      "^visit_id merchandising_id:long", parent="visit_blocks"),
    S("visit_assortments", "visit", "merchandisings.assortment",
      "^visit_id ^merchandising_id assortment_product_code has_assortment "
      "assortment_product_quant:double assortment_product_ir_quant:double "
      "assortment_unavail_reason_name", parent="visit_merchandisings"),
    S("visit_planograms", "visit", "merchandisings.planograms",
      "^visit_id ^merchandising_id planogram_id:long planogram_name planogram_has_photo "
      "planogram_photo_sha planogram_plan_quant:double planogram_plan_sku:double "
      "planogram_fact_quant:double planogram_fact_sku:double", parent="visit_merchandisings"),
    S("visit_planogram_equipments", "visit", "merchandisings.planograms.planogram_equipments",
      "^visit_id ^planogram_id planogram_equipment_id:long planogram_equipment_name",
      parent="visit_planograms"),
    S("visit_planogram_products", "visit", "merchandisings.planograms.planogram_products",
      "^visit_id ^planogram_id planogram_product_name planogram_sample_unit_id:long "
      "planogram_product_code planogram_product_plan_quant:double "
      "planogram_product_fact_quant:double planogram_match planogram_match_face_quant:double "
      "planogram_not_match_reason_name", parent="visit_planograms"),
    S("visit_shelf_own", "visit", "merchandisings.shelf_shares.own_shelf_shares",
      "^visit_id ^merchandising_id own_shelf_share_product_code "
      "own_shelf_share_product_quant:double", parent="visit_merchandisings"),
    S("visit_shelf_competitor", "visit", "merchandisings.shelf_shares.competitor_inventories",
      "^visit_id ^merchandising_id competitor_code competitor_inventory_product_code "
      "competitor_inventory_product_quant:double", parent="visit_merchandisings"),
    S("visit_price_tags", "visit", "merchandisings.price_tags",
      "^visit_id ^merchandising_id price_tag_product_code has_price_tag price:double "
      "no_price_tag_reason_name", parent="visit_merchandisings"),
    S("visit_displays", "visit", "merchandisings.displays",
      "^visit_id ^merchandising_id display_id:long display_name has_display "
      "display_photo_sha no_display_reason_name", parent="visit_merchandisings"),
    S("visit_quizzes", "visit", "quizzes.quiz_sets",
      "^visit_id quiz_name answer has_quiz_photo", parent="visit_blocks"),
    S("visit_equipments", "visit", "equipments",
      "^visit_id equipment_id:long equipment_serial_number equipment_status",
      parent="visit_blocks"),
    S("visit_comments", "visit", "comments",
      "^visit_id comment_name comment_created_by_name", parent="visit_blocks"),
    # ----------------------------------------------------------------- warehouse
    S("cross_movements", "cross_movement", "",
      "from_filial_code external_id movement_id:long subfilial_code to_subfilial_code "
      "from_room_code from_robot_code from_robot_person_code from_warehouse_code from_time "
      "to_filial_code to_warehouse_code to_time currency_code price_type_code "
      "payment_type_code to_payment_type_code request_id:long reason_id:long note barcode "
      "amount:double amount_base:double delivery_number contract_code status",
      key=("external_id",)),
    S("cross_movement_items", "cross_movement", "movement_items",
      "^movement_id ^external_id movement_unit_id:long request_item_id:long "
      "from_inventory_kind on_balance to_inventory_kind product_code card_code expiry_date "
      "serial_number quantity:double price:double amount:double amount_base:double "
      "margin_kind margin_value:double margin_amount:double vat_percent:double "
      "vat_amount:double load_id", parent="cross_movements",
      key=("movement_id", "movement_unit_id")),
    S("internal_movements", "internal_movement", "",
      "filial_code external_id movement_id:long movement_number from_movement_date "
      "to_movement_date request_id:long status from_warehouse_code to_warehouse_code "
      "reason_code note barcode", key=("movement_id",)),
    S("internal_movement_items", "internal_movement", "movement_items",
      "^movement_id external_id movement_item_id:long request_item_id product_code "
      "serial_number inventory_kind on_balance card_code expiry_date quantity:double "
      "batch_number", parent="internal_movements", key=("movement_id", "movement_item_id")),
    S("stocktakings", "stocktaking", "",
      "filial_code external_id stocktaking_id:long stocktaking_number stocktaking_date status "
      "warehouse_code currency_code reason_code note barcode income_batch_number "
      "c_income_amount:double c_income_amount_base:double c_expense_amount:double "
      "c_expense_amount_base:double", key=("stocktaking_id",)),
    S("stocktaking_items", "stocktaking", "stocktaking_items",
      "^stocktaking_id external_id stocktaking_item_id:long product_code inventory_kind "
      "card_code serial_number expiry_date balance_quantity:double quantity:double "
      "batch_number income_price:double income_amount:double", parent="stocktakings",
      key=("stocktaking_id", "stocktaking_item_id")),
    S("writeoffs", "writeoff", "",
      "filial_code external_id writeoff_id:long writeoff_number writeoff_date status "
      "currency_code barcode warehouse_code reason_code note c_amount:double "
      "c_amount_base:double", key=("writeoff_id",)),
    S("writeoff_items", "writeoff", "writeoff_items",
      "^writeoff_id external_id writeoff_item_id:long inventory_kind product_code "
      "serial_number card_code expiry_date quantity:double batch_number", parent="writeoffs",
      key=("writeoff_id", "writeoff_item_id")),
    S("warehouse_inputs", "warehouse_input", "",
      "filial_code external_id input_id:long input_number input_time status warehouse_code note",
      key=("input_id",)),
    S("warehouse_input_items", "warehouse_input", "input_items",
      "^input_id external_id input_item_id:long purchase_id:long purchase_item_id:long "
      "product_code inventory_kind card_code expiry_date quantity:double price:double "
      "margin_kind margin_value:double vat_percent:double vat_amount:double",
      parent="warehouse_inputs", key=("input_id", "input_item_id")),
    S("purchases", "purchase", "",
      "filial_code external_id purchase_id:long purchase_time purchase_number input_date "
      "supplier_code invoice_number invoice_date order_id:long currency_code contract_code "
      "total_margin_kind total_margin_value:double warehouse_code status_code note posted",
      key=("purchase_id",)),
    S("purchase_items", "purchase", "purchase_items",
      "^purchase_id external_id purchase_item_id:long product_code inventory_kind "
      "order_item_id:long on_balance serial_number card_code expiry_date base_price:double "
      "quantity:double price:double margin_kind margin_value:double vat_percent:double "
      "vat_amount:double", parent="purchases", key=("purchase_id", "purchase_item_id")),
    S("purchase_marking_codes", "purchase", "purchase_items.marking_codes",
      "^purchase_id ^purchase_item_id marking_code", parent="purchase_items",
      truthy=("marking_code",), strip=("marking_code",), distinct=True),
    S("logistics", "logistics", "",
      "logistics_id:long external_id delivery_date expeditor_code expeditor_name van_code "
      "van_name lap begin_location end_location cash_register_id:long cash_register_name",
      key=("logistics_id",)),
    S("logistics_deals", "logistics", "deals",
      "^logistics_id deal_id:long status external_id", parent="logistics",
      key=("logistics_id", "deal_id")),
]

SPEC_BY_NAME: dict[str, TableSpec] = {s.name: s for s in SPECS}
OUTPUT_TABLES: list[str] = [s.name for s in SPECS if not s.hidden]

# Pipelines (one per source export) -> output tables, and the three job groups.
PIPELINES: dict[str, list[str]] = {}
for _s in SPECS:
    if not _s.hidden:
        PIPELINES.setdefault(_s.source, []).append(_s.name)

JOB_GROUPS: dict[str, list[str]] = {
    "references": ["products", "natural_person", "services", "product_group", "price_type",
                   "inventory_price", "producers", "legal_entity", "person_group",
                   "workspaces", "contracts", "return_reason"],
    "sales": ["order", "returns", "visit"],
    "warehouse": ["cross_movement", "internal_movement", "stocktaking", "writeoff",
                  "warehouse_input", "purchase", "logistics"],
}
