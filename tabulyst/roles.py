"""Column roles of a table and the contract of the listing table."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Which column plays which part; every operator takes the roles, not fixed names."""

    id: str
    label: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    group: str
    size_parts: tuple[str, ...]
    bath_parts: tuple[tuple[str, float], ...]
    quality: str
    sold: str
    built: str

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical


# Names of the derived columns.
TOTAL_SIZE = "TotalSF"
TOTAL_BATH = "TotalBath"
AGE = "AgeAtSale"
RELATIVE_SIZE = "SF_Rel_to_Nbhd"
QUALITY_SIZE = "Qual_SF_Interact"
PEER_PRICE = "Peer_Comp_Price"

# The listing table contract.
LISTING = Roles(
    id="Id",
    label="SalePrice",
    numeric=(
        "MSSubClass", "LotFrontage", "LotArea", "OverallQual", "OverallCond", "YearBuilt",
        "YearRemodAdd", "MasVnrArea", "BsmtFinSF1", "BsmtFinSF2", "BsmtUnfSF", "TotalBsmtSF",
        "1stFlrSF", "2ndFlrSF", "LowQualFinSF", "GrLivArea", "BsmtFullBath", "BsmtHalfBath", "FullBath",
        "HalfBath", "BedroomAbvGr", "KitchenAbvGr", "TotRmsAbvGrd", "Fireplaces", "GarageYrBlt",
        "GarageCars", "GarageArea", "WoodDeckSF", "OpenPorchSF", "EnclosedPorch", "3SsnPorch",
        "ScreenPorch", "PoolArea", "MiscVal", "MoSold", "YrSold",
    ),
    categorical=(
        "MSZoning", "Street", "Alley", "LotShape", "LandContour", "Utilities", "LotConfig", "LandSlope",
        "Neighborhood", "Condition1", "Condition2", "BldgType", "HouseStyle", "RoofStyle", "RoofMatl",
        "Exterior1st", "Exterior2nd", "MasVnrType", "ExterQual", "ExterCond", "Foundation", "BsmtQual",
        "BsmtCond", "BsmtExposure", "BsmtFinType1", "BsmtFinType2", "Heating", "HeatingQC",
        "CentralAir", "Electrical", "KitchenQual", "Functional", "FireplaceQu", "GarageType",
        "GarageFinish", "GarageQual", "GarageCond", "PavedDrive", "PoolQC", "Fence", "MiscFeature",
        "SaleType", "SaleCondition",
    ),
    group="Neighborhood",
    size_parts=("TotalBsmtSF", "1stFlrSF", "2ndFlrSF"),
    bath_parts=(("FullBath", 1.0), ("HalfBath", 0.5), ("BsmtFullBath", 1.0), ("BsmtHalfBath", 0.5)),
    quality="OverallQual",
    sold="YrSold",
    built="YearBuilt",
)

# The same roles on the frame that plans/listing.py derives from orders and line items.
ORDER_LISTING = Roles(
    id="id",
    label="label",
    numeric=("quality", "year_sold", "size_a", "size_b", "size_c", "full_cnt", "half_cnt",
             "year_built", "acctbal"),
    categorical=("grp", "segment", "status"),
    group="grp",
    size_parts=("size_a", "size_b", "size_c"),
    bath_parts=(("full_cnt", 1.0), ("half_cnt", 0.5)),
    quality="quality",
    sold="year_sold",
    built="year_built",
)
