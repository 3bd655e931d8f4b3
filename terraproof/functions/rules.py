"""Fixed values of the evidence domain: ranks, classes, word patterns, thresholds."""

from __future__ import annotations

# Ranks of the sources; a source that is not listed has rank 0.
SOURCE_RANK = {
    "planning": 1000,
    "licensed-orthophoto": 900,
    "lidar": 850,
    "os-openmap-local": 700,
    "national-trees-outside-woodland": 650,
    "planning-data": 640,
    "microsoft-buildings": 500,
    "wikidata": 300,
    "wikimedia": 250,
    "openaerialmap": 200,
    "osm": 100,
}
UNRANKED_SOURCES = ("ogc-features", "arcgis-features", "geojson")

# Classes in which eligible planning evidence excludes every other source.
LOCKED_CLASSES = ("ride-layout", "ride-support", "path", "path-material", "building", "wall", "barrier", "fence", "water", "rock", "terrain-detail")

# Application statuses: one of the first kind makes an application ineligible, else one of the second eligible.
NEGATIVE_STATUS = ("withdrawn", "refused", "rejected", "declined", "dismissed", "invalid", "pending", "awaiting", "undetermined", "unknown", "cancelled", "canceled")
POSITIVE_STATUS = ("approved", "granted", "permitted", "consented", "lawful")

# Document classes by explicit role, in order: role, class, priority.
ROLE_CLASSES = (
    ("ride-layout", "ride-layout", 150),
    ("ride-support", "ride-layout", 145),
    ("site-plan", "site-plan", 130),
    ("block-plan", "block-plan", 125),
    ("general-arrangement", "general-arrangement", 120),
    ("layout", "layout", 115),
    ("topographical-survey", "topographical-survey", 112),
    ("topographic-survey", "topographical-survey", 112),
    ("landscape", "landscape", 110),
    ("elevation", "elevation", 100),
    ("section", "elevation", 100),
    ("terrain-or-drainage", "drainage-water", 90),
    ("drainage", "drainage-water", 90),
    ("water", "drainage-water", 90),
)
# Document classes by text, in order: class, priority, pattern.
TEXT_CLASSES = (
    ("ride-layout", 150, r"\b(?:ride|roller\s*coaster|coaster|track)\s+(?:layout|plan|ga|general arrangement)\b"),
    ("site-plan", 130, r"\b(?:proposed\s+)?site\s+plan\b"),
    ("block-plan", 125, r"\bblock\s+plan\b"),
    ("general-arrangement", 120, r"\b(?:general\s+arrangement|g\.?a\.?\s+(?:plan|layout|drawing))\b"),
    ("layout", 115, r"\b(?:site|master|overall|proposed)\s+layout\b"),
    ("topographical-survey", 112, r"\b(?:topographical|topographic|topo)\s+(?:survey|plan|drawing)\b"),
    ("landscape", 110, r"\b(?:landscape|landscaping|planting|hardscape|hard\s+landscaping)\b"),
    ("elevation", 100, r"\b(?:elevation|section|roof\s+plan)\b"),
    ("drainage-water", 90, r"\b(?:drainage|water|pond|lake|attenuation)\b.*\b(?:plan|layout|drawing|detail|strategy)\b|\b(?:plan|layout|drawing|detail|strategy)\b.*\b(?:drainage|water|pond|lake|attenuation)\b"),
)
NARRATIVE = r"\b(?:statement|report|letter|application\s+form|cover(?:ing)?\s+letter|certificate|notice|checklist|consultation|decision|condition|assessment|survey\s+report)\b"

# Semantic roles of labels on drawings, in order.
LABEL_ROLES = (
    ("ride-support-candidate", r"\b(?:ride\s+support|track\s+support|support\s+(?:column|post|pier|footing)|column\s+base|support\s+base)\b"),
    ("ride-layout-candidate", r"\b(?:ride|roller\s*coaster|coaster|track)\s+(?:layout|alignment|centreline|centerline)|\b(?:track|ride)\s+layout\b"),
    ("site-path-centerline-candidate", r"\b(?:footbri(?:dge|dde)|footpath|footway|path|walkway|boardwalk|raised\s+walkway|raised\s+path|elevated\s+walkway|elevated\s+path|pedestrian\s+route|deck)\b"),
    ("site-road-centerline-candidate", r"\b(?:access\s+road|service\s+road|road|vehicle\s+route|carriageway)\b"),
    ("building-footprint-candidate", r"\b(?:building|station\s+building|shop|restaurant|toilet|plant\s+room|control\s+room|substation)\b"),
    ("fence-candidate", r"\b(?:fence|fencing|railing|railings|balustrade)\b"),
    ("wall-candidate", r"\b(?:retaining\s+wall|boundary\s+wall|wall)\b"),
    ("barrier-candidate", r"\b(?:barrier|guardrail|guard\s+rail|bollards?)\b"),
    ("water-candidate", r"\b(?:pond|lake|watercourse|stream|ditch|water\s+feature|basin)\b"),
    ("rock-candidate", r"\b(?:rock|rocks|boulder|boulders|rockwork)\b"),
    ("terrain-detail-candidate", r"\b(?:embankment|cutting|earthwork|mound|bank|slope|landform)\b"),
)
ROLE_FEATURE_CLASS = {
    "site-path-centerline-candidate": "path",
    "site-road-centerline-candidate": "path",
    "ride-layout-candidate": "ride-layout",
    "ride-support-candidate": "ride-support",
    "building-footprint-candidate": "building",
    "wall-candidate": "wall",
    "barrier-candidate": "barrier",
    "fence-candidate": "fence",
    "water-candidate": "water",
    "rock-candidate": "rock",
    "terrain-detail-candidate": "terrain-detail",
}

# Cues on attachments.
ATTACHMENT_NARRATIVE = r"\b(?:design\s*(?:and|&)\s*access|landscape\s*(?:and|&)\s*visual\s+impact|lvia|statement|assessment|report|supporting\s+information|cover(?:ing)?\s+letter|application\s+form|decision|notice|certificate)\b"
PROPOSED = r"\b(?:proposed|new)\b"
EXISTING = r"\bexisting\b"
ATTACHMENT_RIDE = r"\b(?:roller\s*coaster|coaster|ride|track)\b.*\b(?:plan|layout|general\s+arrangement|g\.?a\.?|drawing|site\s+plan)\b|\b(?:plan|layout|general\s+arrangement|g\.?a\.?|drawing|site\s+plan)\b.*\b(?:roller\s*coaster|coaster|ride|track)\b"
ATTACHMENT_DRAWING = r"\b(?:site\s+plan|block\s+plan|general\s+arrangement|g\.?a\.?|layout|topographical|topographic|elevation|section|roof\s+plan|landscape\s+plan|drainage\s+plan|drawing)\b"
NAV_TEXT = r"\b(?:documents?|plans?|drawings?|associated\s+documents?|view\s+documents?|application\s+documents?)\b"
NAV_HREF = r"(?:document|drawing|plan|image|attachment)"

# Cues on pages of drawings.
PAGE_RIDE_CONTEXT = r"\b(?:roller\s*coaster|coaster|ride|track|lift\s+hill|station|launch|brake\s+run)\b"
PAGE_RIDE_DRAWING = r"\b(?:roller\s*coaster|coaster|ride|track)\b.*\b(?:plan|layout|general\s+arrangement|g\.?a\.?|drawing|profile)\b|\b(?:plan|layout|general\s+arrangement|g\.?a\.?|drawing|profile)\b.*\b(?:roller\s*coaster|coaster|ride|track)\b"
PAGE_DRAWING = r"\b(?:scale\s*1\s*[:/]|drawing\s*(?:no|number)|revision|rev\.?\s*[a-z0-9]+|general\s+arrangement|g\.?a\.?|site\s+plan|block\s+plan|layout|plan\s+view|north\s+point|do\s+not\s+scale)\b"
PAGE_NARRATIVE = r"\b(?:design\s*(?:and|&)\s*access\s+statement|landscape\s*(?:and|&)\s*visual\s+impact\s+assessment|lvia|chapter|contents|introduction|assessment|methodology|conclusion|appendix|report)\b"
PAGE_ROLE_PRIOR = r"ride-layout|ride\s+layout|coaster|track"
DENSE_PROSE_WORDS = 450
RIDE_PAGE_SCORE = 7

# Gates and thresholds.
EARTH_RADIUS_M = 6371008.8
MIN_CONFIDENCE, MIN_OVERLAP, MAX_OFFSET_M, TOLERANCE_M = 0.86, 0.18, 25.0, 3.0
EQUIVALENT_SHARE, AMBIGUITY = 0.82, 0.9
CONSENSUS_M, CONSENSUS_CONFIDENCE, CONSENSUS_DOCUMENTS = 140.0, 0.72, 2
VARIANT_SEPARATION_M, MAX_VARIANTS = 8.0, 12
ANCHOR_DISTANCE_PX = 120.0
ANCHOR_SEPARATION_PX, LOWEST_COSTS, MIN_REGISTRATION_POINTS, SUPPORT_M = 35.0, 8, 5, 500.0
EDGE_REACH_PX, MIN_PLAN_EDGES, MIN_REFERENCE_EDGES = 4, 80, 50
STRAIGHT_STEP, DIAGONAL_STEP = 0.955, 1.3693  # of a distance transform with a 3 x 3 mask
CONTROL_PADDING_M, METRES_PER_DEGREE = 1000.0, 111320.0

# Places of a page, as shares of its width and height, at which a registration is sampled.
CONTROL_SAMPLES = ((0.15, 0.15), (0.85, 0.15), (0.85, 0.85), (0.15, 0.85), (0.5, 0.5), (0.5, 0.2), (0.8, 0.5), (0.5, 0.8))

# Tags of mapped elements that a reference raster shows, and those with thick lines.
DRAWN_TAGS = ("highway", "building", "barrier", "natural", "water", "waterway", "landuse", "leisure", "tourism", "attraction", "railway", "man_made")
THICK_TAGS = ("highway", "railway", "building", "barrier")

# Classes that the world bridge passes on, and those it knowingly withholds.
BRIDGE_CLASSES = ("barrier", "building", "fence", "path", "rock", "wall", "water")
BRIDGE_WITHHELD = {"terrain-detail": "unsupported-by-world-contract"}

# Milliseconds of a run and of its phases.
RUN_BUDGET_MS = 300000
PHASE_BUDGET_MS = {"bootstrap": 15000, "acquisition": 65000, "planning": 80000, "fusion": 30000, "worldCompile": 75000, "validateAndPackage": 25000, "reserve": 10000}
