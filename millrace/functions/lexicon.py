"""Word lists and tables of the company pipeline, as data. Column builders read them.

FIXED VALUES: everything in capitals below must be as it is for results to be right.
"""


def _listed(text: str) -> list[str]:
    return [x.strip() for x in text.replace("\n", ",").split(",") if x.strip()]


# provider | hosts: a domain and all below it, or =host alone, or * for any | pattern that the path must have
# The first line that fits wins.
PROVIDERS = [
    [cell.strip() for cell in line.split("|", 2)]
    for line in r"""
    Workday | myworkdayjobs.com myworkdaysite.com |
    Workday | workday.com | ^/[^/]+/d/
    Greenhouse | greenhouse.io |
    Lever | lever.co |
    SuccessFactors | successfactors.com successfactors.eu sapsf.com sapsf.eu sapsf.cn |
    SuccessFactors | =jobs.sap.com jobs.hr.cloud.sap |
    iCIMS | icims.com |
    Oracle/Taleo | taleo.net |
    Oracle Recruiting Cloud | oraclecloud.com | hcmUI/CandidateExperience
    SmartRecruiters | smartrecruiters.com |
    Eightfold | eightfold.ai |
    Phenom | phenompeople.com |
    Avature | avature.net |
    Jobvite | jobvite.com |
    BambooHR | bamboohr.com |
    Ashby | ashbyhq.com |
    Workable | workable.com |
    Recruitee | recruitee.com |
    Teamtailor | teamtailor.com |
    Personio | jobs.personio.de jobs.personio.com |
    Cornerstone | csod.com |
    UKG | ultipro.com ukg.net |
    ADP | adp.com | (?i)recruit|career|jobs
    Jobs2Web/SAP | jobs2web.com |
    Paradox | paradox.ai |
    Beamery | beamery.com |
    Talentsoft | talent-soft.com |
    Dayforce | dayforcehcm.com |
    PageUp | pageuppeople.com |
    Kenexa BrassRing | brassring.com |
    softgarden | softgarden.io softgarden.de |
    rexx systems | rexx-systems.com |
    d.vinci | dvinci-hr.com dvinci.de |
    Paylocity | paylocity.com | (?i)recruit
    JazzHR | applytojob.com |
    Breezy | breezy.hr |
    PeopleFluent | peopleclick.com peoplefluent.com |
    Abacus Umantis | umantis.com |
    Jobylon | jobylon.com |
    Zoho Recruit | zohorecruit.com zohorecruit.eu zohorecruit.in |
    Moka | mokahr.com |
    Beisen | hotjob.cn zhiye.com |
    Radancy | tmp.com radancy.net talentbrew.com |
    RippleHire | ripplehire.com |
    Oracle Recruiting Cloud | * | ^/hcmUI/CandidateExperience/
    """.strip().splitlines()
]

# providers whose tenants share a host and differ by the first path segment
SHARED_HOST_PROVIDERS = _listed("Greenhouse, Lever, SmartRecruiters, Ashby, Workable, Jobvite")

# first path segments on shared hosts that are no tenant's board (the empty one too)
NOT_TENANTS = _listed("embed, assets, static, js, css, cdn, scripts, widget, widgets, api")

ASSET_ENDINGS = _listed("js, mjs, css, png, jpg, jpeg, gif, svg, webp, ico, woff, woff2, ttf, eot, pdf, doc, docx, xls, xlsx, ppt, pptx, zip, mp4, mp3")

# query parameters that don't change a page; utm_ and letters besides
TRACKING_NAMES = _listed("_ga, _gl, gclid, fbclid, msclkid, mc_cid, mc_eid, igshid, yclid, icid, intcmp, lnk, gnav, trk, jobpipeline, applysourceoverride, createnewalert")
LANGUAGE_NAMES = _listed("locale, lang, language, hl, userlocation")

# parts of host, path and query of pages that are no portal: accounts, single adverts, fraud notices, news, advice, legal
NOT_PORTAL = (
    r"log-?in|sign-?in|sign-?up|register|logout|/account|my-?account|myprofile|my-profile|/profile|userhome|"
    r"dashboard|saved-?jobs|saved-?searches|/applications|/applicant|/user/|passport\.|mon-compte|"
    r"navbarlevel=my_profile|jobalert|job-alert|talentcommunity|talent-community|jobid=|job_id=|jobdetails|"
    r"job-details|/job/[^/]+|/jobs/\d|requisition|/req/|/vacancy/|/stelle/|/offre/|/viewausschreibung/|applyonline|"
    r"jobposting|/vacancies/\d|fraud|scam|phishing|recruitment-notice|[/-]blogs?/|/news[/-]|newsflash|/press/|"
    r"press-releases?|communiques|/magazine/|/articles?/|^stories\.|\.stories\.|/stories/|/meet-|"
    r"(?:^|[/_-])(?:eoe|eeo)|career-(?:resources|advice|coaching|tips)|toolkit|right-to-work|privacy|datenschutz|"
    r"cookie|impressum|imprint|terms-of-use|terms-and-conditions"
)
ARTICLE_WORDS = 7

SANDBOX = (
    r"sandbox|staging|[-.]uat[-.]|[-.]test[-.]|preprod"
)

CAREER_PHRASES = _listed(r"""
    careers?, jobs?, job search, search jobs, join us, join our team, work with us, work for us, working (?:at|here|with us),
    vacanc(?:y|ies), job openings, open positions, recruitment, recruiting, karriere, jobs & karriere, stellenangebote,
    carri[eè]res?, emplois?, carreras?, empleos?, trabaja con nosotros, carreiras?, trabalhe conosco, vagas,
    lavora con noi, carriere, opportunit[aà] di lavoro, werken bij, vacatures, kariera, praca, kariyer, jobb,
    ledige stillinger, lediga jobb, työpaikat, rekrytointi
""")
CAREER_CJK = _listed("採用, 招聘, 채용, 求人, 人才招聘, 加入我们, 職缺, リクルート")
CAREER_URL_WORDS = _listed("""
    career, careers, jobs, job, joinus, join-us, work-with-us, workwithus, work-for-us, vacancies, recruitment, recruiting,
    karriere, stellenangebote, carrieres, carriere, carreras, empleo, empleos, carreiras, vagas, werkenbij, werken-bij,
    vacatures, kariera, kariyer, saiyo, recruit, talent, jobsearch, job-search
""")
WEAK_URL_WORDS = ["talent"]
EXACT_CAREER_TEXTS = _listed("careers, career, jobs, join us, work with us, karriere, carrières, carreras, empleo, careers & jobs, jobs & careers")

THIRD_PARTY_NAMES = _listed("""
    linkedin, indeed, glassdoor, facebook, twitter, x, instagram, youtube, monster, ziprecruiter, naukri, seek, stepstone, xing,
    tiktok, weibo, wechat, joinhandshake, simplyhired, careerbuilder, jobstreet, totaljobs, reed, zhaopin, 51job, hh, superjob,
    builtin, wellfound, dice, jobindex, infojobs, kariyer, computrabajo, bumeran, pracuj, jobsdb, rikunabi, mynavi, catho,
    almacareer, workland, telegram, myworkday, agencyq
""")
THIRD_PARTY_HOSTS = _listed("play.google.com, apps.apple.com, itunes.apple.com, t.me, youtu.be")

GRADUATE_PHRASES = _listed(r"""
    graduates?, grad(?:uate)? programs?, early[ -]careers?, students?, campus, universit(?:y|ies), interns?, internships?,
    apprentices?, apprenticeships?, trainees?, traineeships?, entry[ -]level, emerging talent, young professionals,
    high ?schools?, nachwuchs, absolventen, praktik(?:um|a), ausbildung, duales studium, studierende, sch[uü]ler,
    werkstudent(?:en)?, stagiaires?, alternance, becarios?, pr[aá]cticas, estagi[aá]rios?, 新卒, 校园招聘, 校招
""")
GRADUATE_URL = (
    r"college|graduate|campus|internship|student|early-?careers?|apprentic|high-?school"
)

REGIONS = _listed("""
    Europe, EMEA, APAC, Asia Pacific, Asia, Americas, North America, Latin America, LATAM, Middle East, Africa, Nordics, Benelux,
    DACH, Oceania, Greater China, ANZ
""")
COUNTRIES = _listed("""
    Argentina, Australia, Austria, Bangladesh, Belgium, Brazil, Bulgaria, Canada, Chile, China, Colombia, Costa Rica, Croatia,
    Czech Republic, Czechia, Denmark, Egypt, Estonia, Finland, France, Germany, Ghana, Greece, Hong Kong, Hungary, India,
    Indonesia, Ireland, Israel, Italy, Japan, Kenya, Korea, South Korea, Latvia, Lithuania, Luxembourg, Malaysia, Mexico, Morocco,
    Netherlands, New Zealand, Nigeria, Norway, Pakistan, Peru, Philippines, Poland, Portugal, Qatar, Romania, Russia,
    Saudi Arabia, Serbia, Singapore, Slovakia, Slovenia, South Africa, Spain, Sri Lanka, Sweden, Switzerland, Taiwan, Thailand,
    Turkey, Türkiye, Ukraine, United Arab Emirates, UAE, United Kingdom, UK, Great Britain, United States, USA, Uruguay, Vietnam,
    Deutschland, España, Italia, Brasil, México, Nederland, Österreich, Schweiz, Suisse, Polska, Sverige, Danmark, Norge,
    Suomi, 日本, 中国, 한국
""")

NAME_SUFFIXES = _listed("""
    inc, incorporated, corp, corporation, co, company, ltd, limited, plc, llc, lp, llp, group, grupo, groupe, gruppe, holdings,
    holding, sa, ag, se, nv, bv, gmbh, spa, ab, asa, oyj, as, kk, the, and, of, de, international, global
""")

JOB_CONTENT = (
    r"search (?:all )?jobs|job search|view (?:all )?jobs|see (?:all )?jobs|explore (?:all )?jobs|find (?:a )?jobs?|"
    r"browse jobs|open positions|open roles|current openings|job openings|job opportunities|apply now|vacancies|"
    r"stellenangebote|offres d.emploi|ofertas de empleo|vagas abertas|posizioni aperte|vacatures"
)

# organisation type | pattern of names | industries that only it has; the first that fits wins
ORGANISATIONS = [
    ("education", r"universit|college|c[ée]gep|school|hochschule|polytechn|institute of technology", ["higher education", "university", "public university"]),
    ("healthcare", r"hospitals?\b|clinic\b|klinik|krankenhaus|health (?:service|system|authority|board)|medical cent(?:er|re)", ["hospital"]),
    ("public body", r"ministry|^city of|county\b|armed forces|\barmy\b|council\b|^government", ["public administration"]),
]
ORGANISATION_TYPES = ["company", "education", "healthcare", "public body"]

IT_INDUSTRY = (
    r"software|information technology|^it\b|technology, information|data infrastructure|"
    r"computer(?! simulation| science)|computing|^internet(?: industry)?$|cloud|web (?:hosting|service)|"
    r"data (?:processing|analytics)|cyber|information security|semiconductor|microelectronics|video game|"
    r"artificial intelligence|networking hardware|information and communication|^technology(?: industry| company)?$|"
    r"outsourcing|digital transformation|supercomputer|quaternary sector"
)

SIZE_BANDS = _listed("1-10, 11-50, 51-200, 201-500, 501-1000, 1001-5000, 5001-10000, 10001+")
UPPER_WORDS = _listed("it, ai, hr, llp, llc, plc, ag, se, sa, nv, bv, usa, uk, ibm, hcl, tcs, sap, bpo, kpo")
LOWER_WORDS = _listed("and, of, the, for, in, de, la, du, von, &")
COLUMN_ALIASES = {"domain": "website", "size range": "size", "linkedin url": "linkedin_url", "year founded": "founded", "current employee estimate": "employee_estimate"}

SCOPE_CAPS = {"regional": 30, "graduate": 3, "affiliate": 5, "other": 3}
PROBE_PATHS = _listed("/careers, /jobs, /en/careers, /career, /about/careers, /about-us/careers, /company/careers, /en/about/careers, /join-us, /work-with-us, /en/jobs, /recruit, /karriere")
PROBE_SUBDOMAINS = ["careers", "jobs"]
# confidence in hundredths
SIGNAL_WEIGHTS = {"linked_from_official_site": 30, "found_by_probe": 20, "on_company_domain": 20, "ats_detected": 20, "name_match": 15, "job_content": 15}

COMPANY_STATUSES = _listed("pending, discovered, verified, needs_review, no_portal_found, failed, excluded")
PLAUSIBLE_EMPLOYEES = 2_500_000

# An approximation of the public suffix list: suffixes of two labels; besides, the last label is the suffix.
TWO_LABEL_SUFFIXES = _listed("""
    co.uk, org.uk, ac.uk, gov.uk, com.au, net.au, org.au, edu.au, gov.au, co.in, net.in, org.in, gov.in, ac.in, co.jp, or.jp, ne.jp, ac.jp, go.jp,
    com.br, org.br, gov.br, com.cn, net.cn, org.cn, gov.cn, edu.cn, com.mx, gob.mx, co.nz, govt.nz, co.za, gov.za, com.sg, gov.sg, com.hk, gov.hk,
    com.tr, gov.tr, com.tw, co.kr, or.kr, go.kr, com.ar, gob.ar, com.co, gov.co, com.my, gov.my, co.id, go.id, com.ph, gov.ph, com.vn, gov.vn,
    com.pl, gov.pl, com.ua, gov.ua, com.sa, gov.sa, com.eg, gov.eg, co.il, gov.il, com.pk, gov.pk, com.bd, gov.bd, gouv.fr, gob.es, com.es, com.pe, gob.pe
""")

INDIAN_PLACES = _listed("""
    andhra pradesh, assam, bihar, chhattisgarh, delhi, new delhi, goa, gujarat, haryana, himachal pradesh, jharkhand, karnataka,
    kerala, madhya pradesh, maharashtra, odisha, punjab, rajasthan, tamil nadu, telangana, uttar pradesh, uttarakhand,
    west bengal, chandigarh, bengaluru, bangalore, mumbai, pune, hyderabad, chennai, noida, gurugram, gurgaon, kolkata
""")
US_PLACES = _listed("""
    al, ak, az, ar, ca, co, ct, de, fl, ga, hi, id, il, in, ia, ks, ky, la, me, md, ma, mi, mn, ms, mo, mt, ne, nv, nh, nj, nm, ny, nc,
    nd, oh, ok, or, pa, ri, sc, sd, tn, tx, ut, vt, va, wa, wv, wi, wy, dc, california, new york, texas, washington, massachusetts,
    illinois, new jersey, georgia, virginia, north carolina
""")

# fields of profile answers: names of JSON keys, in lower case
ANSWER_KEYS = {
    "name": _listed("name, company_name, companyname, title"),
    "website": _listed("website, website_url, websiteurl, company_website"),
    "industry": _listed("industry, industries, industry_name"),
    "company_size": _listed("company_size, companysize, size, employee_count_range, staff_count_range, employees_range"),
    "employee_count": _listed("staff_count, staffcount, employee_count, employeecount, employees, headcount"),
    "headquarters": _listed("headquarters, hq, headquarter, location"),
    "founded": _listed("founded, founded_year, foundedon"),
    "linkedin_url": _listed("linkedin_url, url, company_url, linkedinurl"),
}
# labels of page text, each followed by its value
ANSWER_LABELS = {"website": ["website"], "industry": ["industry", "industries"], "company_size": ["company size", "size"], "headquarters": ["headquarters"], "founded": ["founded"]}
PLACE_KEYS = _listed("city, geographicArea, region, country, name")
LOOKUP_ALIASES = {
    "name": _listed("name, company, company_name, input_name"),
    "linkedin_url": _listed("linkedin_url, linkedin, linkedin_company_url, url"),
    "website": _listed("website, domain, website_url"),
    "country": ["country"],
}
BAND_EDGES = [2_000, 5_000, 10_000, 50_000]

EXPORT_COLUMNS = _listed("""
    company_id, company_name, employee_count, linkedin_url, website, country, industry, organization_type, sector, parent_companies,
    pipeline_status, status_reason, career_page_url, portal_scope, portal_region, final_ats_url, ats_provider,
    verification_status, confidence, last_verified_at, discovered_via
""")
COMPANY_EXPORT_COLUMNS = _listed("""
    company_id, company_name, employee_count, linkedin_url, website, country, industry, organization_type, sector, parent_companies,
    pipeline_status, status_reason, career_page_url, final_ats_url, ats_provider, confidence, last_verified_at,
    other_career_pages
""")
