"""Names and numbers that define the line's data model and its rules."""

from __future__ import annotations

# ---- Fixed values -------------------------------------------------------
# Everything in this block must keep exactly these values and names: results
# are only comparable with other tools reading the same plant data if they do.

TIME_TEXT = "_time"
DESCRIPTION = "Description"
TRAY = "I_MHS_GreenRocketTray"
TEXT_COLUMNS = (TIME_TEXT, DESCRIPTION, TRAY)

SOURCES = ("conveyor", "safety", "cycle", "r01", "r02", "r03", "r04")
MASKED_COLUMNS = ("I_Stopper2_Status", "Q_VFD2_Temperature")

ROBOTS = ("R01", "R02", "R03", "R04")
JOINTS = ("B", "L", "R", "S", "T", "U")
DRIVES = (1, 2, 3, 4)
STOPPERS = (1, 2, 3, 4, 5)

ESTOP = "I_HMI_EStop_Status"
DOOR1 = "I_SafetyDoor1_Status"
DOOR2 = "I_SafetyDoor2_Status"
CYCLE_COUNT = "Q_Cell_CycleCount"
CYCLE_STATE = "Q_Cell_CycleState"
STOPPER1 = "I_Stopper1_Status"
STOPPER3 = "I_Stopper3_Status"
TRANSIT = "inferred_dark_station_time"
TRANSIT_MA50 = "Dark_Station_Time_MA50"
BOTTLENECK = "is_bottleneck"
LABEL = "defect_label"

# Label texts by class number; class 0 is "anything else".
DEFECT_TEXTS = {1: "NoNose", 2: "NoNose,NoBody2", 3: "NoNose,NoBody2,NoBody1"}
CLASS_NAMES = ("Normal", "NoNose", "NoNose,NoBody2", "NoNose,NoBody2,NoBody1")
# class -> (title, severity, message)
DEFECT_MESSAGES = {
    0: ("NORMAL OPERATION", "green", "No defect detected in current assembly cycle."),
    1: (
        "MISSING NOSE ASSEMBLY",
        "orange",
        "Defect: Part is missing the nose structure. Divert to Station 5.",
    ),
    2: (
        "MISSING NOSE & BODY 2",
        "red",
        "Critical Defect: Missing nose and secondary chassis. Divert immediately.",
    ),
    3: (
        "CRITICAL STRUCTURAL DEFECT (Nose/Body 1 & 2)",
        "red",
        "Severe Failure: Complete structural assembly missing parts.",
    ),
}
# class -> displayed probability of classes 0, 1, 2, 3
CLASS_CONFIDENCE = {
    0: (0.98, 0.01, 0.005, 0.005),
    1: (0.05, 0.85, 0.07, 0.03),
    2: (0.01, 0.04, 0.90, 0.05),
    3: (0.01, 0.01, 0.03, 0.95),
}

DEFAULT_TRANSIT_S = 12.5
BOTTLENECK_S = 15.5
JAM_S = 20.0
TRANSIT_FAST_S = 14.0
TRANSIT_SLOW_S = 16.0

MEAN_SHORT = 10
MEAN_LONG = 60
TRANSIT_MEAN = 50

IDEAL_CYCLE_S = 300.0

LOAD_LIMIT_N, LOAD_SPAN = 1500.0, 30.0
VIBRATION_LIMIT_N, VIBRATION_SPAN = 120.0, 2.0
TEMP_LIMIT_C, TEMP_SLOPE = 72.0, 5.0
GOOD_HEALTH, WARN_HEALTH = 80.0, 50.0

CLIP_LOW_C, CLIP_HIGH_C = 50.0, 110.0
DRIVE_BASE_KW, DRIVE_KNEE_C, DRIVE_KW_PER_C = 8.5, 60.0, 0.1
LEGACY_KW = 60.0
CO2_KG_PER_KWH = 0.82
SCRAP_CO2_KG, SCRAP_LBS = 2.5, 4.2
SHARE_FLOOR = 0.001

CAUSE_ESTOP = "Emergency Stop Active (HMI)"
CAUSE_DOOR1 = "Safety Door 1 Open"
CAUSE_DOOR2 = "Safety Door 2 Open"
# (State shown in the breakdown, KPI column it comes from)
BREAKDOWN_STATES = (
    ("Operating Uptime", "operating_s"),
    ("E-Stop Downtime", "estop_s"),
    ("Safety Door 1 Open", "door1_s"),
    ("Safety Door 2 Open", "door2_s"),
)

# scenario -> {column: value at the current row}
SCENARIOS = {
    "Baseline Operations (Normal)": {},
    "Thermal Deviation (VFD 1)": {
        "Q_VFD1_Temperature": 89.2,
        "Q_VFD2_Temperature": 78.5,
    },
    "Chassis Feed Transit Delay (Stopper 2)": {TRANSIT: 32.8, BOTTLENECK: 1},
    "Kinematic Fault State (Robot R04)": {
        "M_R04_SJointAngle_Degree": 0.0,
        "M_R04_SJoint_Velocity": 0.0,
        "M_R04_SJoint_Acceleration": 0.0,
    },
    "Mechanical Gripper Overload (Robot R03)": {
        "I_R03_Gripper_Load": 4850.0,
        "I_R03_Gripper_Load_MA10": 4500.0,
        LABEL: 3,
    },
}

# (metric, lower limit, advice); an alert fires when value < limit
ALERT_RULES = (
    (
        "availability",
        0.90,
        "Check if safety door limit switches are loose or audit operator movement around the cell.",
    ),
    (
        "performance",
        0.85,
        "Check Station 2 conveyor rollers for mechanical drag and verify drive belt tension.",
    ),
    (
        "quality",
        0.98,
        "Inspect the upstream nose-cone loading feeder and check part alignment sensors.",
    ),
    (
        "robot_health",
        60.0,
        "Inspect pneumatic gripper seals, check air line pressures, and re-grease robot joints.",
    ),
    (
        "vfd_health",
        50.0,
        "Clean the VFD cooling cabinet air filters and make sure exhaust fans are working properly.",
    ),
)

FORECAST_STEPS = 15
FORECAST_DECAY_S = 0.1
HISTORY_TEMPS, HISTORY_TRANSITS = 50, 100

TEST_SHARE, SPLIT_SEED = 0.2, 42
TREES, TREE_DEPTH, LEARNING_RATE = 100, 6, 0.1
# ---- End of fixed values ------------------------------------------------


def angle(robot: str, joint: str) -> str:
    return f"M_{robot}_{joint}JointAngle_Degree"


def velocity(robot: str, joint: str) -> str:
    return f"M_{robot}_{joint}Joint_Velocity"


def acceleration(robot: str, joint: str) -> str:
    return f"M_{robot}_{joint}Joint_Acceleration"


def load(robot: str) -> str:
    return f"I_{robot}_Gripper_Load"


def temperature(drive: int) -> str:
    return f"Q_VFD{drive}_Temperature"


def stopper(number: int) -> str:
    return f"I_Stopper{number}_Status"


# Columns each raw source carries, in file order, without the time text.
SOURCE_COLUMNS = {
    "conveyor": [stopper(n) for n in STOPPERS] + [temperature(d) for d in DRIVES] + [TRAY],
    "safety": [ESTOP, DOOR1, DOOR2],
    "cycle": [CYCLE_COUNT, CYCLE_STATE, DESCRIPTION],
    **{r.lower(): [load(r)] + [angle(r, j) for j in JOINTS] for r in ROBOTS},
}
