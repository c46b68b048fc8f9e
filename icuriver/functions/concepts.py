"""Concept ids and score bands.

Fixed values: results are only right with exactly these ids and limits.
"""

# Diagnosis of interest.
SEPSIS = 132797

# Therapeutic antibiotics.
THERAPEUTIC_ANTIBIOTICS = (
    36258242, 41114247, 40072606, 40730323, 40737711, 40754936, 35154887, 36257100, 43023020,
    44125439, 40040317, 40846188, 35761065, 36883151, 44086327, 35606304, 41239210, 40928582,
    43744909, 1760659, 40748259, 40740535, 40023477, 40077149, 40731671, 40735073, 40052913,
    36886030, 35604141, 35750082, 40747347, 36896811, 40734887, 40736859, 40241491,
)
# Antibiotics given as prophylaxis.
PROPHYLACTIC_ANTIBIOTICS = (43295826, 42479695, 40902269, 21091196, 40020952, 40736877)
# Cultures; the negative id is deliberate and matches nothing.
CULTURES = (1761466, 3009986, -3040827, 3003714, 3025037, 4196406)

# Oxygen.
OXYGEN = (3014080, 3005629, 3025408, 3024882)
VENTILATOR_OXYGEN = (3025408, 3024882)
OXYGEN_DEVICE = 45769206
PAO2 = 3027315
SPECIMEN = 3053213
KPA_UNIT = 152
KPA_TO_MMHG = 7.50061683
ROOM_AIR = 0.21

# Estimated oxygen fraction by device: (device ids, ((flow from, fraction), ...)).
# A step holds up to the next one; below the first step it is room air.
FIO2_STEPS = (
    ((4224038,), ((1, 0.22), (2, 0.25), (3, 0.27), (4, 0.30), (5, 0.35))),
    (
        (45759142,),
        ((1, 0.22), (2, 0.25), (3, 0.27), (4, 0.30), (5, 0.35), (6, 0.40), (7, 0.45), (8, 0.50)),
    ),
    (
        (4192506, 4044008, 4160626, 4235033, 4208623, 4165535, 4145528),
        ((6, 0.60), (7, 0.70), (8, 0.80), (9, 0.85), (10, 0.90)),
    ),
    ((45879331,), ()),
)

# Laboratory and bedside.
PLATELETS = (3007461,)
BILIRUBIN = (40757494, 3006140)
LACTATE = (3047181, 3014111)
MEAN_BLOOD_PRESSURE = (21490852, 21492241)
URINE = (3014315, 3007123, 21491173)
CREATININE = (3020564,)
BODY_WEIGHT = (3026600, 3013762, 3023166, 3025315)
FLUID_INTAKE = (3010494, 3037253, 3013308)

# Vasoactive drugs.
DOPAMINE = 36411287
DOBUTAMINE = 21088391
EPINEPHRINE = 19076867
NOREPINEPHRINE = 2907531
VASOACTIVE = (DOPAMINE, DOBUTAMINE, EPINEPHRINE, NOREPINEPHRINE)
DOSE_PATTERN = r"(\d+\.?\d*) mg"
RATE_PATTERN = r"@ (\d+\.?\d*) mg/uur"
# Equivalent dose factor by substring of the lower-case name, tried in this order.
DOSE_FACTORS = (("epinephrine", 1.0), ("norepinephrine", 1.0), ("dopamine", 0.01), ("dobutamine", 0.01))

# Coma score: component concept -> answer concept -> points.
EYES = 3016335
MOTOR = 3026549
VERBAL = 3009094
EYES_POINTS = {45877537: 1, 45883351: 2, 45880465: 3, 45880466: 4}
MOTOR_POINTS = {45878992: 1, 45878993: 2, 45879885: 3, 45882047: 4, 45880468: 5}
VERBAL_POINTS = {36311192: 1, 45877384: 2, 45883352: 3, 45877601: 4, 45883906: 5, 45877602: 6}

# Everything the scores and the cohort read from the measurements.
COHORT_MEASUREMENTS = (
    *OXYGEN, PAO2, SPECIMEN, *PLATELETS, *BILIRUBIN, *LACTATE, *MEAN_BLOOD_PRESSURE, *URINE, *CREATININE,
    *BODY_WEIGHT, EYES, MOTOR, VERBAL, *CULTURES,
)

# Bands: (low operator, low, high operator, high, points).
COAGULATION_BANDS = (
    (">=", 100, "<", 150, 1), (">=", 50, "<", 100, 2), (">=", 20, "<", 50, 3), (">=", None, "<", 20, 4),
)
LIVER_BANDS = (
    (">=", 20, "<", 33, 1), (">=", 33, "<", 102, 2), (">=", 102, "<", 204, 3), (">=", 204, "<", None, 4),
)
COMA_BANDS = (
    (">=", 13, "<", 15, 1), (">=", 10, "<", 13, 2), (">=", 6, "<", 10, 3), (">=", None, "<", 6, 4),
)
URINE_BANDS = ((">", 200, "<", 500, 3), (">=", None, "<", 200, 4))
CREATININE_BANDS = (
    (">=", 110, "<", 171, 1), (">=", 171, "<", 300, 2), (">=", 300, "<=", 440, 3), (">", 440, "<", None, 4),
)
PRESSURE_BANDS = ((">=", None, "<", 70, 1),)

# Dose bands of the report: (label, above, up to).
DOSE_BANDS = (("]0-0.08]", 0.0, 0.08), ("]0.08-0.22]", 0.08, 0.22), ("]0.22-0.45]", 0.22, 0.45), (">0.45", 0.45, None))
