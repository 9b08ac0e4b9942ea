"""Dimension tables: class composition, density limits, albedo bands, phases.

The tables are small constants; ``frame`` functions give them as DataFrames for
broadcast joins. Fixed values, taken as facts from the published tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Class, group, density g/cm3, metal, silicate, carbon, ice, PGM factor.
CLASSES = """
B C-complex 1.3 0.01 0.3 0.04 0.2 1.0
C C-complex 1.5 0.01 0.35 0.04 0.15 1.0
Cb C-complex 1.4 0.01 0.32 0.04 0.18 1.0
Cg C-complex 1.5 0.02 0.38 0.04 0.12 1.0
Cgh C-complex 1.6 0.03 0.4 0.04 0.1 1.0
Ch C-complex 1.5 0.02 0.38 0.04 0.1 1.0
S S-complex 2.7 0.06 0.75 0.01 0.0 1.55
Sa S-complex 2.8 0.06 0.8 0.01 0.0 1.55
Sk S-complex 2.6 0.06 0.78 0.02 0.0 1.55
Sl S-complex 2.7 0.06 0.78 0.01 0.0 1.55
Sq S-complex 2.8 0.06 0.78 0.01 0.0 1.55
Sr S-complex 2.9 0.06 0.82 0.01 0.0 1.55
Sv S-complex 3.0 0.06 0.85 0.01 0.0 1.55
X X-complex 2.29 0.33 0.44 0.02 0.05 2.0
Xc X-complex 2.37 0.32 0.47 0.02 0.04 2.0
Xe X-complex 2.9 0.25 0.65 0.01 0.0 1.5
Xk X-complex 3.8 0.45 0.45 0.01 0.0 2.0
A A-type 3.2 0.05 0.9 0.01 0.0 0.5
D D-type 1.2 0.01 0.25 0.04 0.25 1.0
Z D-type 1.2 0.01 0.25 0.04 0.25 1.0
K K-type 2.5 0.08 0.72 0.08 0.0 1.16
L L-type 2.8 0.05 0.85 0.02 0.0 1.86
O O-type 2.9 0.08 0.85 0.01 0.0 0.5
Q Q-type 2.7 0.06 0.72 0.02 0.0 1.55
R R-type 3.1 0.05 0.9 0.01 0.0 0.5
T T-type 1.8 0.05 0.4 0.04 0.1 1.0
V V-type 2.9 0.01 0.9 0.01 0.0 0.2
M X-complex 3.9 0.5 0.45 0.01 0.0 2.0
E X-complex 3.2 0.1 0.85 0.01 0.0 1.5
P C-complex 1.2 0.02 0.35 0.04 0.15 1.0
F C-complex 1.4 0.01 0.35 0.04 0.15 1.0
G C-complex 1.5 0.02 0.38 0.04 0.1 1.0
"""

# Density ceiling per group, g/cm3; the floor is 0.25 for all.
CEILINGS = """
C-complex 3.6
D-type 3.6
K-type 3.6
L-type 3.6
T-type 5.0
S-complex 5.0
Q-type 5.0
A-type 5.0
O-type 5.0
R-type 5.0
V-type 5.0
X-complex 5.0
Unknown 5.0
"""

# Median albedo per class.
CLASS_ALBEDO = """
A 0.2620
Ad 0.1820
B 0.0670
Bk 0.0850
C 0.0620
Cb 0.0550
Cd 0.0575
Cg 0.0530
Cgh 0.0630
Cgx 0.0880
Ch 0.0520
Cl 0.1880
Co 0.0560
Cx 0.0590
D 0.0820
Dl 0.1775
Ds 0.1265
E 0.5964
K 0.1840
Kl 0.1190
L 0.2030
Ld 0.1730
Ls 0.2220
M 0.1330
O 0.1345
P 0.0520
Q 0.2520
Qv 0.1968
R 0.3165
S 0.2340
S: 0.2320
Sa 0.2515
Sk 0.2335
Sl 0.2310
Sq 0.2440
Sr 0.2614
Sv 0.2875
T 0.1110
V 0.3355
X 0.0800
Xc 0.0880
Xd 0.0740
Xe 0.1990
Xk 0.1055
Xl 0.1340
Xt 0.1115
Z 0.0650
"""

# Half-open bands of the semi-major axis, and the albedo in each.
BELT_BANDS = [(0.0, 1.3, 0.1870), (1.3, 2.0, 0.4135), (2.0, 2.5, 0.1900), (2.5, 2.82, 0.0860), (2.82, 3.27, 0.0660), (3.27, 3.7, 0.0570), (3.7, 4.6, 0.0550), (4.6, 5.5, 0.0700), (5.5, 1e9, 0.0880)]
NEO_BANDS = [(0.0, 1.3, 0.1870), (1.3, 2.0, 0.1700), (2.0, 2.5, 0.1370), (2.5, 2.82, 0.0620), (2.82, 1e9, 0.0370)]
# Past OUTER_EDGE, the first band whose upper H is not passed.
OUTER_EDGE = 5.5
H_BANDS = [(3.0, 0.4481), (6.0, 0.1468), (7.0, 0.0871), (8.0, 0.0755), (1e9, 0.0585)]
LAST_RESORT_ALBEDO = 0.0780

# Bodies with a measured volume, km3, and its sigma.
SHAPE_VOLUMES = [("433", 2503.0, 25.0), ("4", 7.49e7, 0.01e7), ("101955", 0.061354, 0.00006)]

# Albedo bounds between P, M and E, and counts of each in X and Xc.
X_BOUNDS = (0.10, 0.30)
X_COUNTS = {"X": (4741, 3022, 350), "Xc": (40, 27, 7)}

# Phases in the order of output, by group.
PHASES = {
    "metal": "nickel-iron kamacite taenite tetrataenite cohenite schreibersite",
    "silicate": "olivine orthopyroxene pyroxene enstatite plagioclase phyllosilicates silicates",
    "carbon": "carbon organics",
    "ice": "water carbon_dioxide ammonia",
    "accessory": "troilite pyrrhotite pentlandite niningerite oldhamite daubreelite magnetite chromite ilmenite "
    "perovskite spinel hibonite carbonates merrillite chlorapatite",
}

# Classes, group of phases, shares of that group.
SHARES = """
B,C,Cb,F,Cg,Ch,G,Cgh,S,Sq,Q,Sk,Sl,Sa,Sr,Sv,E,P,D,Z,T,A,R,O,K,L,V | metal | nickel-iron 1.0
M,Xk | metal | nickel-iron 0.985, schreibersite 0.015
Xe | metal | nickel-iron 0.97, schreibersite 0.03
B,C,Cb,F | silicate | phyllosilicates 0.95, olivine 0.05
Cg,Ch,G | silicate | phyllosilicates 0.85, olivine 0.10, pyroxene 0.05
Cgh | silicate | phyllosilicates 0.50, olivine 0.40, pyroxene 0.10
S,Sq,Q,Sk,Sl | silicate | olivine 0.58, orthopyroxene 0.24, pyroxene 0.06, plagioclase 0.12
Sa | silicate | olivine 0.75, orthopyroxene 0.12, pyroxene 0.03, plagioclase 0.10
Sr | silicate | olivine 0.45, orthopyroxene 0.35, pyroxene 0.08, plagioclase 0.12
Sv | silicate | olivine 0.30, orthopyroxene 0.30, pyroxene 0.20, plagioclase 0.20
M,Xk | silicate | enstatite 0.70, plagioclase 0.20, olivine 0.10
Xe | silicate | enstatite 0.90, plagioclase 0.10
E | silicate | enstatite 0.95, plagioclase 0.03, olivine 0.02
P,D,Z,T | silicate | silicates 1.0
A | silicate | olivine 0.95, orthopyroxene 0.05
R | silicate | olivine 0.60, orthopyroxene 0.30, pyroxene 0.05, plagioclase 0.05
O | silicate | olivine 0.50, orthopyroxene 0.50
K | silicate | olivine 0.75, pyroxene 0.20, plagioclase 0.05
L | silicate | olivine 0.60, pyroxene 0.30, plagioclase 0.10
V | silicate | pyroxene 0.45, orthopyroxene 0.15, plagioclase 0.37, olivine 0.03
B,C,Cb,F,Cg,Ch,G,Cgh,K | carbon | carbon 0.70, organics 0.30
P,D,Z,T | carbon | organics 0.60, carbon 0.40
S,Sq,Q,Sk,Sl,Sa,Sr,Sv,M,Xk,Xe,E,A,R,O,L,V | carbon | carbon 1.0
B,C,Cb,F,Cg,Ch,G,Cgh | ice | water 1.0
P,D,Z,T | ice | water 0.892, carbon_dioxide 0.102, ammonia 0.006
"""

# Classes and accessory phases, as shares of the whole body.
ACCESSORIES = """
B,C,Cb,F | magnetite 0.07, troilite 0.05, carbonates 0.03
Cg,Ch,G | troilite 0.03, magnetite 0.02, carbonates 0.01
Cgh | magnetite 0.05, troilite 0.02
S,Sq,Q,Sa,Sr,Sv | troilite 0.055, chromite 0.005
Sk | troilite 0.055, chromite 0.005, magnetite 0.02
Sl | troilite 0.055, chromite 0.005, spinel 0.03
M,Xk | troilite 0.02
Xe | troilite 0.08
E | troilite 0.01
P,D,Z | magnetite 0.05, troilite 0.03, carbonates 0.03
T | troilite 0.08, magnetite 0.03
A | chromite 0.01, troilite 0.01
R | troilite 0.01, chromite 0.005
O | troilite 0.02
K | magnetite 0.03, spinel 0.03, troilite 0.02
L | spinel 0.05, troilite 0.02
V | chromite 0.01, ilmenite 0.01, troilite 0.005
"""

# Classes, a phase, and the finer phases it divides into.
REFINEMENTS = """
B,C,Cb,F,Cg,Ch,G,Cgh,P,D,Z,T,A,R,O,K,L | nickel-iron | kamacite 0.89, taenite 0.11
S,Sq,Q,Sa,Sr,Sv,Sk,Sl | nickel-iron | kamacite 0.55, taenite 0.38, tetrataenite 0.07
M,Xk | nickel-iron | kamacite 0.88, taenite 0.11, cohenite 0.01
Xe,E,V | nickel-iron | kamacite 1.0
B,C,Cb,F | troilite | pyrrhotite 0.70, pentlandite 0.30
Cg,Ch,G,P,D,Z | troilite | pyrrhotite 0.65, pentlandite 0.35
Cgh,K | troilite | pentlandite 0.50, pyrrhotite 0.50
Xe | troilite | troilite 0.625, niningerite 0.25, oldhamite 0.0875, daubreelite 0.0375
E | troilite | troilite 0.60, oldhamite 0.30, daubreelite 0.10
"""

# Further accessories of the refined table.
REFINED_ACCESSORIES = """
S,Sq,Q,Sa,Sr,Sv,Sk,Sl | merrillite 0.004, chlorapatite 0.002
K | perovskite 0.002, hibonite 0.003
L | perovskite 0.003, hibonite 0.005
"""

# Classes whose estimate may lie below the measured bodies, and why.
BELOW_BECAUSE = {
    "B": "measured ones are large",
    "K": "one body is measured",
    "Sq": "measured ones are large",
    "Xc": "two bodies are measured",
}


def _rows(text: str) -> list[tuple]:
    """One tuple per class and phase; numbers last."""
    out = []
    for line in text.strip().splitlines():
        *keys, parts = [p.strip() for p in line.split("|")]
        for cls in keys[0].split(","):
            for part in parts.split(","):
                name, share = part.split()
                out.append((cls, *keys[1:], name.replace("_", " "), float(share)))
    return out


def class_rows() -> list[tuple]:
    out = []
    for line in CLASSES.strip().splitlines():
        cls, group, *numbers = line.split()
        out.append((cls, group, *map(float, numbers)))
    return [*out, ("Unknown", "Unknown", None, None, None, None, None, 1.0)]


def pairs(text: str) -> list[tuple[str, float]]:
    return [(a, float(b)) for a, b in (line.split() for line in text.strip().splitlines())]


def phase_order() -> list[tuple]:
    out = []
    for group, names in PHASES.items():
        out += [(n.replace("_", " "), group) for n in names.split()]
    return [(n, g, k) for k, (n, g) in enumerate(out)]


def _frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def classes(spark: SparkSession) -> DataFrame:
    return _frame(
        spark,
        class_rows(),
        "class string, grp string, density double, metal double, silicate double, carbon double, ice double, pgm double",
    )


def density_limits(spark: SparkSession) -> DataFrame:
    return _frame(spark, [(g, 0.25, c) for g, c in pairs(CEILINGS)], "grp string, floor double, ceiling double")


def class_albedo(spark: SparkSession) -> DataFrame:
    return _frame(spark, pairs(CLASS_ALBEDO), "class string, albedo double")


def bands(spark: SparkSession, neo: bool) -> DataFrame:
    return _frame(spark, NEO_BANDS if neo else BELT_BANDS, "a_min double, a_max double, albedo double")


def h_bands(spark: SparkSession) -> DataFrame:
    return _frame(spark, H_BANDS, "h_max double, albedo double")


def shape_volumes(spark: SparkSession) -> DataFrame:
    return _frame(spark, SHAPE_VOLUMES, "designation string, volume_km3 double, volume_sigma_km3 double")


def x_counts(spark: SparkSession) -> DataFrame:
    rows = [(row, cls, n) for row, counts in X_COUNTS.items() for cls, n in zip("PME", counts)]
    return _frame(spark, rows, "class string, member string, n long")


def shares(spark: SparkSession) -> DataFrame:
    return _frame(spark, _rows(SHARES), "class string, grp string, phase string, share double")


def accessories(spark: SparkSession) -> DataFrame:
    return _frame(spark, _rows(ACCESSORIES), "class string, phase string, fraction double")


def refinements(spark: SparkSession) -> DataFrame:
    return _frame(spark, _rows(REFINEMENTS), "class string, phase string, finer string, share double")


def refined_accessories(spark: SparkSession) -> DataFrame:
    return _frame(spark, _rows(REFINED_ACCESSORIES), "class string, phase string, fraction double")


def phases(spark: SparkSession) -> DataFrame:
    return _frame(spark, phase_order(), "phase string, grp string, place int")


def below_because(spark: SparkSession) -> DataFrame:
    return _frame(spark, list(BELOW_BECAUSE.items()), "class string, reason string")
