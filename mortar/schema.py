"""Declared tape schemas, one per agency and file.

The loan tapes are headerless, so column order is file order.  Every column
carries a logical type, an optional default that replaces null, a keep flag
and, for dates, the Spark datetime pattern of its text form.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LOGICAL_TYPES = ("float", "double", "int", "string", "date")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str
    default: object = None
    keep: bool = True
    pattern: str | None = None

    @property
    def spark_type(self) -> T.DataType:
        """Type of the cleaned column."""
        return spark_type(self.dtype)

    @property
    def read_type(self) -> T.DataType:
        """Type used when scanning text: dates stay text until parsed."""
        return T.StringType() if self.dtype == "date" else spark_type(self.dtype)


def spark_type(dtype: str) -> T.DataType:
    """Logical type name -> Spark type.

    32-bit floats are widened to double so that rates entering a power keep
    full precision; unknown names read as text.
    """
    if dtype in ("float", "double"):
        return T.DoubleType()
    if dtype == "int":
        return T.IntegerType()
    if dtype == "date":
        return T.DateType()
    return T.StringType()


@dataclass(frozen=True)
class TapeSchema:
    agency: str
    kind: str
    columns: tuple[ColumnSpec, ...]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def keep_names(self) -> list[str]:
        return [c.name for c in self.columns if c.keep]

    @property
    def dropped_names(self) -> list[str]:
        return [c.name for c in self.columns if not c.keep]

    @property
    def date_columns(self) -> list[ColumnSpec]:
        return [c for c in self.columns if c.dtype == "date"]

    @property
    def defaulted(self) -> list[ColumnSpec]:
        return [c for c in self.columns if c.default is not None and c.dtype != "date"]

    def __getitem__(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def __contains__(self, name: str) -> bool:
        return any(c.name == name for c in self.columns)

    def read_struct(self) -> T.StructType:
        """Schema handed to the text reader (never inferred)."""
        return T.StructType([T.StructField(c.name, c.read_type, True) for c in self.columns])


@dataclass(frozen=True)
class Agency:
    name: str
    acquisition: TapeSchema
    performance: TapeSchema
    cost_columns: tuple[str, ...]
    proceeds_columns: tuple[str, ...]


def _tape(agency: str, kind: str, rows) -> TapeSchema:
    return TapeSchema(agency, kind, tuple(ColumnSpec(*r) for r in rows))


# --- fixed values: the published column layouts ---------------------------
# (name, logical type, default for null, keep, Spark date pattern), file order.

FNMA_ACQUISITION = _tape("FNMA", "acquisition", [
    ("LOAN_ID", "string", None, True, None),
    ("ORIG_CHN", "string", None, True, None),
    ("SellerName", "string", None, False, None),
    ("ORIG_RT", "float", None, True, None),
    ("ORIG_AMT", "double", None, True, None),
    ("ORIG_TRM", "int", None, True, None),
    ("ORIG_DTE", "date", None, True, "MM/yyyy"),
    ("FRST_DTE", "date", None, True, "MM/yyyy"),
    ("OLTV", "float", 0, True, None),
    ("OCLTV", "float", 0, True, None),
    ("NUM_BO", "int", -1, True, None),
    ("DTI", "int", -1, True, None),
    ("CSCORE_B", "float", -1, True, None),
    ("FTHB_FLG", "string", None, True, None),
    ("PURPOSE", "string", None, True, None),
    ("PROP_TYP", "string", None, True, None),
    ("NUM_UNIT", "int", -1, True, None),
    ("OCC_STAT", "string", None, True, None),
    ("STATE", "string", None, True, None),
    ("ZIP_3", "string", None, True, None),
    ("MI_PCT", "int", 0, True, None),
    ("Product_Type", "string", None, True, None),
    ("CSCORE_C", "int", -1, True, None),
    ("MI_TYPE", "string", "0", True, None),
    ("RELOCATION_FLG", "string", None, True, None),
])

FNMA_PERFORMANCE = _tape("FNMA", "performance", [
    ("LOAN_ID", "string", None, True, None),
    ("ACT_DTE", "date", None, True, "MM/dd/yyyy"),
    ("SERVICER", "string", None, False, None),
    ("LAST_RT", "float", None, True, None),
    ("LAST_UPB", "double", None, True, None),
    ("LOAN_AGE", "int", None, True, None),
    ("Months_To_Legal_Mat", "int", -1, True, None),
    ("Adj_Month_To_Mat", "int", -1, True, None),
    ("Maturity_Date", "date", None, True, "MM/yyyy"),
    ("MSA", "string", None, False, None),
    ("DLQ_STATUS", "string", None, True, None),
    ("MOD_FLAG", "string", None, False, None),
    ("ZB_CODE", "string", None, False, None),
    ("ZB_DTE", "date", None, False, "MM/yyyy"),
    ("LPI_DTE", "date", None, False, "MM/dd/yyyy"),
    ("FCC_DTE", "date", None, False, "MM/dd/yyyy"),
    ("DISP_DTE", "date", None, False, "MM/dd/yyyy"),
    ("FCC_COST", "float", None, False, None),
    ("PP_COST", "float", None, False, None),
    ("AR_COST", "float", None, False, None),
    ("IE_COST", "float", None, False, None),
    ("TAX_COST", "float", None, False, None),
    ("NS_PROCS", "float", None, False, None),
    ("CE_PROCS", "float", None, False, None),
    ("RMW_PROCS", "float", None, False, None),
    ("O_PROCS", "float", None, False, None),
    ("NON_INT_UPB", "float", None, True, None),
    ("PRIN_FORG_UPB_FHFA", "float", None, True, None),
    ("REPCH_FLAG", "string", None, True, None),
    ("PRIN_FORG_UPB_OTH", "string", None, True, None),
    ("TRANSFER_FLG", "string", None, True, None),
])

FRED_ACQUISITION = _tape("FRED", "acquisition", [
    ("CSCORE_B", "float", -1, True, None),
    ("FRST_DTE", "date", None, True, "yyyyMM"),
    ("FTHB_FLG", "string", None, True, None),
    ("MAT_DTE", "date", None, True, "yyyyMM"),
    ("MSA", "string", None, False, None),
    ("MI_PCT", "int", 0, True, None),
    ("NUM_UNIT", "int", -1, True, None),
    ("OCC_STAT", "string", None, True, None),
    ("OCLTV", "float", 0, True, None),
    ("DTI", "int", -1, True, None),
    ("ORIG_AMT", "double", None, True, None),
    ("OLTV", "float", 0, True, None),
    ("ORIG_RT", "float", None, True, None),
    ("ORIG_CHN", "string", None, True, None),
    ("ppmt_pnlty", "string", None, True, None),
    ("Product_Type", "string", None, True, None),
    ("STATE", "string", None, True, None),
    ("PROP_TYP", "string", None, True, None),
    ("ZIP_3", "string", None, True, None),
    ("LOAN_ID", "string", None, True, None),
    ("PURPOSE", "string", None, True, None),
    ("ORIG_TRM", "int", None, True, None),
    ("NUM_BO", "int", -1, True, None),
    ("SellerName", "string", None, False, None),
    ("SERVICER", "string", None, False, None),
    ("flag_sc", "string", None, False, None),
])

FRED_PERFORMANCE = _tape("FRED", "performance", [
    ("LOAN_ID", "string", None, True, None),
    ("ACT_DTE", "date", None, True, "yyyyMM"),
    ("LAST_UPB", "double", None, True, None),
    ("DLQ_STATUS", "string", None, True, None),
    ("LOAN_AGE", "int", None, True, None),
    ("Months_To_Legal_Mat", "int", -1, True, None),
    ("REPCH_FLAG", "string", None, True, None),
    ("MOD_FLAG", "string", None, False, None),
    ("ZB_CODE", "string", None, False, None),
    ("ZB_DTE", "date", None, False, "yyyyMM"),
    ("LAST_RT", "float", None, True, None),
    ("NON_INT_UPB", "float", None, True, None),
    ("LPI_DTE", "date", None, False, "yyyyMM"),
    ("CE_PROCS", "float", None, False, None),
    ("NS_PROCS", "float", None, False, None),
    ("RMW_PROCS", "float", None, False, None),
    ("EXpenses", "float", None, False, None),
    ("LEGAL_COST", "float", None, False, None),
    ("MAINT_COST", "float", None, False, None),
    ("TAX_COST", "float", None, False, None),
    ("MISC_COST", "float", None, False, None),
    ("ACTUAL_LOSS", "float", None, True, None),
    ("MOD_LOSS", "float", None, True, None),
    ("STEPMOD_IND", "string", None, False, None),
    ("DPM_IND", "string", None, False, None),
    ("ELTV", "float", None, False, None),
])

# Default cost and proceeds components.  FNMA's are the published formula;
# FRED's are this engine's own definition over the FRED columns.
FNMA_COSTS = ("FCC_COST", "PP_COST", "AR_COST", "IE_COST", "TAX_COST")
FNMA_PROCEEDS = ("NS_PROCS", "CE_PROCS", "RMW_PROCS", "O_PROCS")
FRED_COSTS = ("LEGAL_COST", "MAINT_COST", "TAX_COST", "MISC_COST")
FRED_PROCEEDS = ("NS_PROCS", "CE_PROCS", "RMW_PROCS")
# --- end of fixed values ---------------------------------------------------

FNMA = Agency("FNMA", FNMA_ACQUISITION, FNMA_PERFORMANCE, FNMA_COSTS, FNMA_PROCEEDS)
FRED = Agency("FRED", FRED_ACQUISITION, FRED_PERFORMANCE, FRED_COSTS, FRED_PROCEEDS)


def agency(name: str = "FNMA") -> Agency:
    """Schema registry lookup; any name other than FNMA selects FRED."""
    return FNMA if name == "FNMA" else FRED
