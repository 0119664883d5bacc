"""Word lists and literals of a domain, kept apart from the operators that use them.

Everything that belongs to a place or a trade is a field of Profile; the defaults are those of the New York court-sport
data. Another state or trade is another Profile, not another engine. The gazetteer is a table and comes in as one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# The lists below must hold exactly these entries for results to agree.
SPORTS = ("pickleball", "tennis", "basketball", "volleyball", "badminton", "squash", "racquetball", "padel", "futsal", "handball", "netball")
SHARED_LOCALS = (
    "info", "contact", "hello", "membership", "memberships", "operations", "admin", "office", "frontdesk", "front desk", "reservations", "bookings",
    "support", "inquiries", "enquiries", "general", "team", "play", "courts", "programs",
)
FREE_MAIL_SEEN = (
    "gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com", "icloud.com", "msn.com", "live.com", "comcast.net", "verizon.net", "me.com",
    "mac.com", "protonmail.com", "proton.me", "gmx.com", "mail.com", "optonline.net", "sbcglobal.net", "roadrunner.com", "rochester.rr.com", "twc.com",
    "earthlink.net",
)
FREE_MAIL_FINAL = (
    "gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com", "icloud.com", "msn.com", "live.com", "comcast.net", "verizon.net", "me.com",
    "mac.com", "protonmail.com", "proton.me", "gmx.com", "mail.com", "yandex.com",
)
VANITY_LABELS = (
    "www", "www2", "book", "booking", "bookings", "reserve", "reservations", "play", "portal", "members", "member", "my", "app", "apps", "secure", "shop",
    "store", "ir", "investors", "info", "home", "web", "mail", "email", "go", "get", "new", "old", "beta", "staging", "m", "mobile", "club", "courts",
)
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "com.au", "co.nz", "ny.us")
LISTING_HOSTS = (
    "yelp.", "tripadvisor.", "facebook.", "instagram.", "twitter.", "x.com", "tiktok.", "youtube.", "linkedin.", "pinterest.", "reddit.", "wikipedia.",
    "yellowpages.", "mapquest.", "google.", "bing.", "duckduckgo.", "mojeek.", "apple.com", "eventbrite.", "meetup.", "groupon.", "indeed.",
    "ziprecruiter.", "glassdoor.", "places.", "foursquare.", "nextdoor.", "patch.com", "niche.com", "usnews.com", "courtreserve.com",
    "playbypoint.com", "pickleheads.com", "places.pickleplay.com", "teamunify.com", "leagueapps.com", "sportsengine.com", "teamsnap.com", "amazon.",
    "ebay.", "craigslist.", "zillow.", "realtor.", "apartments.com", "startpage.com", "brave.com", "yahoo.com", "ecosia.org", "searx", "qwant.",
    "courtsource.us", "picklecourtsnearme.com", "playtimescheduler.com", "pickleballchatbots.com", "tenniscircuits.com", "usta.com", "globalsportsjobs.",
    "gympik.", "tripsavvy.", "thumbtack.", "angi.com", "bbb.org", "manta.com", "chamberofcommerce.com", "buzzfile.com", "dnb.com", "zoominfo.com",
    "crunchbase.", "mindbodyonline.com", "clubautomation.com", "daysmartrecreation.com", "peerspace.com", "swimply.com", "mytennislessons.com",
    "goodrun.app", "playyourcourt.com", "globaltennisnetwork.com", "clublocker.com", "squadz.com", "giggster.com", "splacer.co", "thisopenspace.com",
    "sparkplace.", "takelessons.com", "lessons.com", "coachup.com", "teachme.to", "eventbrite.com", "active.com", "signupgenius.com", "gofundme.com",
    "tripadvisor.com", "expedia.", "booking.com", "hotels.com", "airbnb.",
)
TITLES = (
    "Owner", "Co-Owner", "Founder", "Co-Founder", "President", "CEO", "General Manager", "Managing Director", "Executive Director",
    "Director of Operations", "Operations Director", "Facility Manager", "Facilities Manager", "Club Director", "Athletic Director",
    "Director of Racquets", "Director of Tennis", "Director of Pickleball", "Tennis Director", "Membership Director", "Director of Membership",
    "Program Director", "Sports Director", "Head of Operations", "Manager",
)
NOT_A_NAME = (
    "director", "manager", "owner", "founder", "president", "ceo", "coo", "cfo", "chair", "coach", "staff", "team", "operations", "membership",
    "athletic", "tennis", "pickleball", "squash", "racquet", "program", "general", "executive", "managing", "facility", "facilities", "club", "head",
    "assistant", "associate", "senior", "department", "office", "contact", "email", "phone", "address", "hours", "home", "about", "our", "jcc", "ymca",
    "ywca", "center", "centre", "complex", "academy", "school", "college", "university", "association", "foundation", "company", "corp", "inc", "llc",
    "group", "holdings", "partners", "manhattan", "brooklyn", "queens", "bronx", "staten", "york", "island", "county", "village", "basketball",
    "volleyball", "football", "soccer", "hockey", "baseball", "softball", "lacrosse", "track", "field", "swimming", "diving", "golf", "wrestling",
    "rowing", "crew", "athletics", "mens", "womens", "boys", "girls", "varsity", "junior", "freshman",
)
NOT_A_FIRST_NAME = (
    "you", "your", "we", "our", "us", "the", "this", "that", "these", "those", "it", "its", "they", "their", "there", "here", "if", "when", "while",
    "please", "contact", "book", "join", "learn", "find", "get", "new", "all", "my", "his", "her", "now", "today", "welcome", "home", "about", "more",
    "read", "view", "call", "email", "sign", "log", "search", "menu", "skip", "open", "close", "free", "every", "each", "also", "whether", "both",
    "either", "any", "some", "most", "best", "top", "great", "first", "last", "next", "back", "play", "players", "meet", "with", "from", "into", "over",
    "under", "before", "after", "during", "since", "until", "because", "so", "and", "but", "or",
)
HONORIFICS = (
    "dr", "mr", "mrs", "ms", "miss", "mx", "prof", "professor", "coach", "rev", "reverend", "fr", "father", "sr", "sister", "sen", "rep", "hon", "sir",
    "dame", "capt", "sgt", "lt", "col", "gen",
)
NOT_A_PERSON = (
    "mens", "men", "womens", "women", "boys", "boy", "girls", "girl", "varsity", "junior", "senior", "freshman", "basketball", "volleyball", "football",
    "soccer", "hockey", "baseball", "softball", "lacrosse", "tennis", "swimming", "diving", "golf", "wrestling", "rowing", "crew", "track", "field",
    "athletics", "staff", "team", "department", "office", "general", "main", "front", "head", "assistant", "associate", "community", "engagement",
    "placement", "testing", "admissions", "advancement", "development", "marketing", "communications", "alumni", "registrar", "financial", "career",
    "counseling", "wellness", "facilities", "maintenance", "security", "catering", "events", "information", "services", "resources", "relations",
)
ROLE_LOCALS = (
    "owner", "gm", "manager", "director", "president", "ceo", "head", "pro", "tennis", "pickleball", "racquet", "squash", "membership", "memberships",
    "operations", "frontdesk", "desk", "reserve", "reservations", "book", "bookings", "play", "court", "courts", "program", "programs", "coach", "admin",
)
STREET_WORDS = (
    "st", "street", "ave", "avenue", "rd", "road", "blvd", "boulevard", "dr", "drive", "ln", "lane", "way", "pkwy", "parkway", "hwy", "highway", "route",
    "rte", "rt", "pl", "place", "ct", "court", "ter", "terrace", "cir", "circle", "sq", "square", "tpke", "turnpike", "ext", "suite", "ste", "floor", "fl",
    "unit", "apt", "box", "po",
)
STREET_SUFFIXES = (
    "St", "Street", "Ave", "Avenue", "Rd", "Road", "Blvd", "Boulevard", "Dr", "Drive", "Ln", "Lane", "Way", "Pkwy", "Parkway", "Hwy", "Highway", "Rte",
    "Route", "Pl", "Place", "Ct", "Court", "Ter", "Terrace", "Cir", "Circle", "Sq", "Square", "Tpke", "Turnpike", "Broadway", "Concourse",
)
NAME_STOP_WORDS = ("the", "a", "an", "inc", "llc", "ltd", "co", "corp", "company", "club", "center", "centre", "of", "and")
BRAND_STOP_WORDS = ("tennis", "sports", "court", "courts", "clubs", "center", "centre")
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "ndash": "-", "mdash": "-", "rsquo": "'", "lsquo": "'", "ldquo": '"',
    "rdquo": '"', "hellip": "...", "reg": "", "trade": "", "copy": "",
}
NUMBER_WORDS = {
    "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12,
    "fourteen": 14, "sixteen": 16, "twenty": 20,
}
SUBPAGE_HINTS = (
    "contact", "about", "staff", "our[-\\s]?team", "leadership", "management", "directory", "who[-\\s]?we[-\\s]?are", "meet[-\\s]?the", "administration",
    "membership", "facilit", "courts?", "rentals?", "programs?", "athletics",
)
RETAIL_SIGNALS = (
    "add to cart", "free shipping", "size (chart|guide)", "shop now", "your cart", "sold out", "checkout", "shopping bag", "shipping (and|&) returns",
    "returns? policy",
)
GENERIC_TITLES = "^(home|homepage|home page|welcome|index|main|start|untitled|official site|official website|site|page \\d+)$"
INDOOR = "indoor|indoors|climate[-\\s]?controlled|air[-\\s]?conditioned courts?|under (?:one )?roof|domed?|bubble|field ?house|fieldhouse|inside courts?"
OUTDOOR = "outdoor|outdoors|open[-\\s]air"
PAID = (
    "member(ship)?s?|dues|join|rental|rent|reserve|booking|book a court|court time|rates?|pricing|fees?|tuition|league|clinic|lesson|program"
    "|drop[-\\s]?in|day pass|punch card"
)
NAME_KINDS = (
    ("\\bsportsplex\\b", "Sportsplex"), ("\\bfield ?house\\b", "Fieldhouse"), ("\\bY\\.?M\\.?C\\.?A\\.?\\b|\\bJCC\\b", "YMCA / JCC"), ("\\bcountry club\\b", "Country Club"),
    ("\\bpickleball\\b", "Pickleball Club"), ("\\bracquet(ball)?\\b|\\btennis\\b|\\bsquash\\b", "Racquet / Tennis Club"), ("\\b(university|college)\\b", "College / University"),
)
TEXT_KINDS = (
    ("\\bsportsplex\\b", "Sportsplex"), ("\\bfield ?house\\b", "Fieldhouse"), ("\\bY\\.?M\\.?C\\.?A\\.?\\b|\\bYMCA\\b|\\bJCC\\b|jewish community center", "YMCA / JCC"),
    ("\\bcountry club\\b", "Country Club"), ("\\b(racquet|tennis) club\\b", "Racquet / Tennis Club"), ("\\bpickleball (club|court|center|centre)\\b", "Pickleball Club"),
    ("\\b(university|college)\\b", "College / University"), ("\\b(high school|academy|prep school|school)\\b", "School"),
    ("\\bathletic (club|center|centre|complex)\\b", "Athletic Center"), ("\\bindoor sports?\\b|\\bsports (complex|center|centre)\\b", "Indoor Sports Complex"),
    ("\\b(health|fitness) club\\b|\\bgym\\b", "Health Club"), ("\\bclub\\b", "Private Club"),
)
EXCLUDED = (
    "\\b(town|city|village|county) of\\b", "\\bparks? (and|&) rec(reation)?\\b", "\\bdepartment of parks\\b", "\\bmunicipal\\b", "\\bhomeowners?,? association\\b",
    "\\bHOA\\b", "\\bapartment (homes|community|living)\\b", "\\bresidences?\\b.*\\bamenit", "\\bpublic (park|courts?)\\b", "\\bfree (to the )?public\\b",
)
CASE_BOUND = ("\\bHOA\\b",)
PUBLISHER_DOMAINS = (
    "(magazine|gazette|herald|tribune|chronicle|newspaper|journalism)", "(^|[.-])(news|media|blog|patch|press|observer)([.-]|$)",
    "^(aol|msn|yahoo|usatoday|nytimes|nypost|huffpost|buzzfeed|patch|wikimedia|wikipedia)\\.", "^[wk][a-z]{3}\\.(com|org|net|tv|fm)$",
)
MASTHEADS = "\\b(journal|gazette|herald|tribune|chronicle|newsday|magazine|newspaper|broadcasting|newschannel|dispatch|this week)\\b"
WEAK_MASTHEADS = "\\b(news|times|record|daily|weekly|media|radio|tv)\\b"
VENUE_WORDS = (
    "\\b(club|court|courts|tennis|pickleball|squash|racquet|racquetball|badminton|volleyball|basketball|sportsplex|fieldhouse|field house|gym|gymnasium"
    "|athletic|recreation|ymca|jcc|academy|arena|dome|complex)\\b"
)
AREA_CODES = ("212", "315", "332", "347", "516", "518", "585", "607", "631", "646", "680", "716", "718", "838", "845", "914", "917", "929", "934")
FL_CODES = (
    "239", "305", "321", "352", "386", "407", "448", "561", "656", "689", "727", "754", "772", "786", "813", "850", "863", "904", "941", "954",
)
TN_CODES = ("423", "615", "629", "731", "865", "901", "931")
TX_CODES = (
    "210", "214", "254", "281", "325", "346", "361", "409", "430", "432", "469", "512", "682", "713", "737", "806", "817", "830", "832", "903", "915",
    "936", "940", "945", "956", "972", "979",
)
QUERY_TEMPLATES = (
    "indoor pickleball courts {m}", "indoor tennis club {m}", "indoor basketball courts rental {m}", "indoor volleyball club {m}", "indoor badminton club {m}", "squash club {m}", "racquetball courts {m}",
    "indoor padel club {m}", "indoor futsal {m}", "sportsplex {m}", "fieldhouse indoor courts {m}", "indoor sports complex {m}", "athletic club indoor courts {m}", "racquet club {m}", "country club indoor tennis {m}",
    "YMCA gymnasium court rental {m}", "JCC indoor courts {m}", "court rental {m}", "basketball court rental hourly {m}", "private school gymnasium rental {m}", "college recreation center court rental {m}",
    "platform tennis club {m}", "paddle tennis club {m}", "tennis center {m}", "pickleball center {m}", "sports dome {m}", "swim and tennis club {m}", "volleyball facility rental {m}", "basketball training facility {m}",
    "indoor soccer and basketball facility {m}", "recreation center court rental {m}",
)
NY_STATEWIDE = (
    "indoor pickleball facilities New York State directory", "USTA Eastern indoor tennis facilities New York", "indoor sports complex New York State list", "New York volleyball clubs indoor facility list", "New York squash clubs list",
    "best indoor pickleball courts upstate New York", "sportsplex New York State",
)
GUESS_NOTE = "Guessed emails are UNVERIFIED pattern permutations - not published addresses."


@dataclass(frozen=True)
class Profile:
    """What the operators need to know about a state and a trade."""

    state: str = "NY"
    state_name: str = "New York"
    zip_prefix: str = "1\\d{4}"
    mention: str = "New York (?:State|City)"
    area_codes: tuple[str, ...] = AREA_CODES
    gov_suffix: str = "\\.(gov|mil|ny\\.us)$"
    city_alias: dict[str, str] = field(default_factory=lambda: {"^(nyc|new york city|n\\.?y\\.?c\\.?)$": "New York"})
    sports: tuple[str, ...] = SPORTS


NY = Profile()
FL = Profile(state="FL", state_name="Florida", zip_prefix="3[234]\\d{3}", mention="Florida", area_codes=FL_CODES, gov_suffix="\\.(gov|mil|fl\\.us)$", city_alias={})
TN = Profile(state="TN", state_name="Tennessee", zip_prefix="3[78]\\d{3}", mention="Tennessee", area_codes=TN_CODES, gov_suffix="\\.(gov|mil|tn\\.us)$", city_alias={})
TX = Profile(state="TX", state_name="Texas", zip_prefix="7[5-9]\\d{3}", mention="Texas", area_codes=TX_CODES, gov_suffix="\\.(gov|mil|tx\\.us)$", city_alias={})
