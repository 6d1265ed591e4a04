"""Column names of each report, as its readers expect them."""

PREPACK_IN = [
    "SKU_ID", "PREPACK_CODE", "MATERIAL_SKU_ID", "CONDITION_ID", "Dates", "YYYYMM", "UV", "TAG_ID", "Gare",
    "FROM_LOC_ID", "SUPPLIER_ID", "NAME",
]

PREPACK_OUT = [
    "DATES", "SUPPLIER_ID", "SUPPLIER", "CUSTOMER_ID", "CUSTOMER", "SKU_ID", "REFERENCE_ID", "DESCRIPTION",
    "SCOST", "QTY", "UNITES", "SALES_QTY", "CONTAINER_ID",
]

GATE_PUTAWAY = ["YYMM", "CODE", "SKU_ID", "UPDATE_QTY", "FROM_LOC_ID", "GATE_ID"]

OFFLOAD = ["YYMM", "CODE", "SKU_ID", "TAG_ID", "UPDATE_QTY", "FROM_LOC_ID"]

CARTONS = ["YYMM", "DATES", "TYPES", "STATUS", "QTY"]

STOCK_WEIGHT = ["SKU_ID", "QTY_ON_HAND", "LOCATION_ID", "WORK_ZONE", "EACH_WEIGHT"]

LOADLIST = [
    "CONTAINER_ID", "Table", "Key", "Customer ID", "DLX Order ID", "DLX Line ID", "CRM Order ID", "CRM Line ID",
    "DEA Order ID", "DEA Line ID", "Date", "Hour", "Ship by date", "Sku ID", "Qty Ordered", "Qty to move",
    "Sales Multiple", "Load List ID", "Not Combined", "Status", "Work Zone", "Pallet ID", "Work Group",
    "Consignment", "From location", "To location", "Order Type", "Container Type", "Pallet weight",
    "Pallet volume", "Carrier ID", "Trailer ID", "Service Level", "Dispatch Method", "Width", "Height", "Depth",
    "Value", "Currency", "Hazmat ID", "Dock Door", "Shipdock ID", "Net weight", "Each weight", "Each volume",
    "Tare", "FINAL_LOC_ID", "Quai", "Date/hour",
]
