"""The rule vocabularies, and the rule set that carries them to every operator."""

from __future__ import annotations

from dataclasses import dataclass

# They have to be these for right results.
STRONG_JOB = ("jobid=", "job_id=", "jid=", "gh_jid=", "req=", "requisition", "jobdetail", "jobdetails", "job-detail", "job-details", "jobdescription", "job-description", "job_desc", "apply?job", "apply/job", "apply?jid")
STRONG_JOB_CONFIGURED = (*STRONG_JOB, "jobcode=")
WEAK_JOB = ("/job/", "/jobs/", "/career/", "/careers/", "/position/", "/positions/", "/opening/", "/openings/", "/opportunity/", "/opportunities/", "/posting", "/apply")
EXCLUDED_JOB = ("privacy", "terms", "cookies", "accessibility", "benefits", "about", "news", "blog", "press", "investor", "sustainability", "location", "locations", "contact", "support", "faq", "login", "signin", "signup", "register", "policy", "mailto:", "tel:", "javascript:", "search?", "search/")
NON_CAREER = (
    "privacy", "privacy-policy", "terms", "terms-of-use", "cookies", "cookie-policy", "accessibility", "benefits", "about", "about-us", "news", "newsroom", "blog", "press", "press-release", "media", "media-kit",
    "investor", "investors", "investor-relations", "sustainability", "esg", "location", "locations", "contact", "contact-us", "support", "support-center", "help", "help-center", "faq", "customer-support",
    "knowledge-base", "kb/", "team", "leadership", "resource-center", "resources", "events", "webinar", "case-study", "case-studies", "testimonials", "partners", "partner", "login", "signin", "signup", "register",
    "account", "policy", "mailto:", "tel:", "javascript:", "search?", "search/", "/search/", "?s=", "sitemap", "sitemap.xml", "rss", "feed", "/tag/", "/category/", "/author/", "wp-json", "wp-content", "wp-admin",
    "cdn-cgi", "facebook.com", "linkedin.com", "instagram.com", "twitter.com", "x.com", "youtube.com", "tiktok.com", "pinterest.com", "home",
)
EXCLUDED_JOB_CONFIGURED = tuple(x for x in NON_CAREER if x not in ("team", "leadership")) + ("emailme.asp", "jobcode=0")
NON_JOB_TEXT = (
    "about", "about us", "about-us", "our story", "who we are", "our company", "company", "contact", "contact us", "contact-us", "faq", "help", "help center", "support center", "customer support", "support",
    "connect", "connect with us", "team", "our team", "leadership", "news", "blog", "press", "investor", "privacy", "privacy policy", "cookie policy", "terms", "terms of use", "cookies", "legal", "security",
    "compliance", "accessibility", "sitemap", "site map", "home", "learn more", "services", "products", "solutions", "resources", "resource center", "community", "events", "webinars", "case studies",
    "testimonials", "partners", "subscribe", "newsletter", "follow us", "facebook", "instagram", "linkedin", "twitter", "x", "youtube", "tiktok", "employee login", "client login", "member login", "portal", "back to top",
)
JOB_TEXT = ("job", "jobs", "career", "careers", "opening", "openings", "position", "positions", "vacancy", "vacancies", "requisition", "apply", "hiring", "opportunit", "talent")
STOP_TEXT = ("about", "us", "contact", "faq", "help", "support", "news", "blog", "privacy", "terms", "cookie", "cookies", "sitemap", "home", "team", "investor", "connect")
ATS_DOMAINS = (
    "myworkdayjobs.com", "myworkdaysite.com", "greenhouse.io", "lever.co", "icims.com", "oraclecloud.com", "oraclecloudapps.com", "workforcenow.adp.com", "adp.com", "smartrecruiters.com", "successfactors.com",
    "successfactors.eu", "successfactors.cn", "jobvite.com", "taleo.net", "bamboohr.com", "entertimeonline.com", "dayforcehcm.com", "dayforce.com", "paycomonline.net", "ultipro.com", "clearcompany.com",
    "ashbyhq.com", "workable.com", "recruitee.com", "paylocity.com", "isolvedhire.com", "ukg.com", "ceridian.com", "jobs.net", "eightfold.ai", "teamtailor.com", "jobscore.com", "applytojob.com", "breezy.hr",
    "jazzhr.com", "brassring.com", "avature.net", "jobsoid.com", "applicantpro.com", "applicantstack.com", "pageuppeople.com", "talentreef.com", "recruiterbox.com", "hireology.com", "catsone.com", "pinpointhq.com",
    "paycor.com", "personio.com", "personio.de", "personio.io", "ceipal.com", "neogov.com", "governmentjobs.com", "manatal.com", "join.com", "newtonsoftware.com", "hirebridge.com", "peopleadmin.com",
    "careerplug.com", "jobadder.com", "homerun.co", "jobylon.com", "gohire.io", "workstream.us", "hirehive.com", "occupop.com", "recruitcrm.io", "zohorecruit.com",
)
ATS_HOSTED = (
    "breezy.hr", "teamtailor.com", "recruitee.com", "jobscore.com", "ashbyhq.com", "workable.com", "applytojob.com", "pinpointhq.com", "applicantstack.com", "applicantpro.com", "talentreef.com", "catsone.com",
    "jobsoid.com", "avature.net", "brassring.com", "homerun.co", "jobylon.com", "gohire.io", "careerplug.com", "jobadder.com", "hirehive.com", "occupop.com", "workstream.us", "recruitcrm.io", "zohorecruit.com",
)
ATS_TEMPLATES = (
    ("workday", ("myworkdayjobs.com", "myworkdaysite.com")),
    ("oracle", ("oraclecloud.com", "oraclecloudapps.com")),
    ("adp", ("workforcenow.adp.com", "adp.com")),
    ("successfactors", ("successfactors.com", "successfactors.eu", "successfactors.cn")),
    ("dayforce", ("dayforcehcm.com", "dayforce.com", "ceridian.com")),
    ("personio", ("personio.com", "personio.de", "personio.io")),
    ("neogov", ("neogov.com", "governmentjobs.com")),
)
ATS_HOST_HINT = r"(^|\.)(jobs?|careers?|recruit(ing|ment)?|talent|hiring|apply)(\.|$)"
CAREER_WORDS = "career|careers|jobs?|opening|openings|position|positions|apply|recruit|candidateexperience|candidateportal|talent|opportunit|vacanc|requisition|employment|jobsearch|job-board|jobboard|joblist|searchjobs|jobdetail|current-openings|join-us|work-with-us"
ATS_PATH_HINT = f"({CAREER_WORDS})"
CAREER_PATH_HINT = f"({CAREER_WORDS}|hiring)"
ATS_QUERY_HINT = r"(gh_jid|gh_src|lever[-_](origin|source)|jobid|job_id|jobreq|requisition|selectedmenukey=currentopenings|careerssearch|career_ns|in_iframe|familyid|jobboard|openingid|postingid|positionid|partnerid=|siteid=|jobpostid=|company=|cid=|ccid=)"
FILE_PATH = r"\.(pdf|docx?|xlsx?|zip|rar|7z|png|jpe?g|gif|svg|webp|bmp|ico|css|js|json|xml|txt|mp3|mp4|avi|mov|wmv)$"
STRONG_SIGNAL = r"(jobid=|job_id=|gh_jid=|jid=|jobpostid=|openingid=|postingid=|positionid=|requisition|careersection|searchjobs|jobsearch|candidateexperience|candidateportal|/job/|/jobs/|/careers?/|/openings?/|/positions?/|/apply(/|\?|$))"
JOB_DETAIL = r"/job/|/jobs/details/|jobdetails|jobintroduction\.action|jobid=|job_id=|gh_jid=|jid=|requisition|req=|positionid=|postingid=|/apply/jobs/details/"
BOARD_LANDING = r"careerhome\.action|searchjobs|jobsearch|search\.aspx|/jobs/?$|/jobs\?|/career/?$|/career\?|/careers/?$|/careers\?"
STRONG_CAREER_PATH = r"(^|/)(career|careers|job|jobs|join-us|work-with-us|current-openings|vacancies|opportunities|positions|employment)(/|$|[-_])"
SUPPORTING_CAREER_PATH = "(opening|openings|apply|talent|hiring|recruit|candidateexperience|candidateportal|jobsearch|searchjobs|jobboard|job-board|joblist|listing)"
ARTICLE_PATH = "(announc|news|blog|press|article|story|event|webinar|case-stud|testimonial|investor|team|leadership|about|contact|privacy|terms|office)"
LISTING_PATH = "(listing|searchjobs|jobsearch|jobboard|job-board|joblist)"
HARD_NON_CAREER = ("about", "aboutus", "contact", "contactus", "faq", "help", "support", "privacy", "terms", "cookie", "cookies", "sitemap", "home", "news", "blog", "press", "investor", "team", "leadership", "benefits", "locations", "location", "accessibility", "login", "signin", "signup", "register", "policy")
#: Fixed values.
EXPIRY_HINT = r"\b(404|403|410|500|502|503|504|error|expired|no jobs?|not found|forbidden|access denied|job closed|position filled|vacancy closed)\b"
CHALLENGES = ("sgcaptcha", "cf-chl", "challenge-platform", "_incapsula_resource", "distil_r_captcha", "/captcha")
#: Fixed values.
SOCIAL = ("whatsapp.com", "instagram.com", "twitter.com", "pinterest.com", "googleads.g.doubleclick.net", "glassdoor.com", "glassdoor.co.in", "tumblr.com", "facebook.com", "youtube.com")
EXCLUDED_HOSTS = ("indeed", "ziprecruiter", "pcrecruiter", "stabilityhealthcare", "cms24-7", "elitemedicalstaffing", "columbiacountyga", "google", "hrapply", "fountain", "staffmine", "philipsrecruiting", "advancedprofessionals", "smartsearchonline", "synergystaffing", "ageatia", "mskcc", "iconplc", "usgrpinc", "nysais", "vitas")
#: Fixed values.
FINAL_EXTENSIONS = (".zip", ".rar", ".7z", ".tar", ".gz", ".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".csv", ".txt", ".xml", ".rss", ".atom", ".jpg", ".jpeg", ".png", ".gif", ".svg", ".webp", ".ico", ".bmp", ".mp3", ".wav", ".mp4", ".avi", ".mov", ".wmv", ".mkv", ".exe", ".dmg", ".apk")
#: What an error message says where trying again is of no use.
FINAL_ERRORS = ("invalid url", "err_invalid_url", 'protocol "mailto:"', 'protocol "tel:"', 'protocol "javascript:"', "unsupported protocol")
#: Fixed values.
BOARD_ROUTE_WORDS = ("jobs", "job", "embed", "job_board", "board")
DETAIL_WORDS = ("detail", "details", "view", "viewjob", "posting", "position", "opportunity", "opening", "apply")
CONTAINER_WORDS = ("job", "jobs", "career", "careers", "opening", "openings")
ENVELOPE = ("_clf_payload", "_clf_retry", "_clf_first_seen_at")
SOCIAL_HOSTS = ("www.apple.com", "www.whatsapp.com", "www.facebook.com", "www.instagram.com", "twitter.com", "www.passtumblr.com", "www.google.com", "www.youtube.com")
#: Fixed values.
LISTING_ENDS = (
    "/x/openings", "#menu-toggle", "main", "#filter", "/vacancy-search-results.aspx#", "/vacancy-search-results.aspx#close-search-refine", "vacancy-search-results.aspx",
    "services.php", "index.php", "search-jobs-v8/", "search-apply1/", "search-apply1", "/overview", "overview/", "hudl-applicant-and-candidate-privacy-policy", "support", "signup",
    "index.shtml", "hiring-process", "benefits", "subscribe/", ".gov/", "about/", "careers/", "jobs-engineer", "contact.html", "search/", "email-alerts/",
    "activate-privacy-policy.html", "privacy-policy/", "homepage.htm", "services.html", "/terms-and-conditions.html", "/careers.html", "login.xhtml", "faq", "terms-of-use",
    "privacy-notice", "news", "/contact/", "?searchphrase=", "/staff", "/services", "/feedback", "search.html", "ViewFAQ.aspx", "savedJobs.html", "MyChart/", "save_job/",
    "terms-and-conditions", "/faqs", "faqs.html", "/career-areas", "/benefits.html", "company.html", "#content", "#culture", "policies/terms", "#cookies", "Contact_Us",
    "/Newsletters", ".com/apply/", "prem-offline-form", "/research", "/search-and-apply/", "feed.atom", "/create", "/jobs/#", "/jobs/#go", "=Filter+by+Keywords&",
    "job_function=-1", "employment-opportunities/", "order=ASC", "irving", "careers/#", "/patients", "/forgot", "Research & Innovation", "Patients & Visitors", "terms/", "/refer",
    "/responsibility", "/terms-conditions", "/services", ".org/", "our-story/", "/our-story", "/privacy-policy", "forms/", "save_job/", "open-positions/", "topjobs/",
    "/google-translate", ".edu/", ".org/", "/volunteer", "/join", "/privacy/", "/pay-your-bill", "/terms/", "/pay-a-bill", "/submissions", "/about", "/privacy", "/search",
    "/your-application", "/job_search#", ".ca//", "/contact-emerald/", "/talk-to-us/", "/connect.html", "/contact-us.html", "/contact-us", "/contact", "/contact.html", "contactus",
    "aboutus", "/job-opportunities/", "/0/", "login", "employment/#", "careers.html#", "jobs#", "reviews", "jobs/#", "job-openings", "Careers.aspx", "application.html",
    "job-openings#", "review/", "#menu", "career.html#", "results/#", "privacy-policy", "create", "Privacy.html", "join-us/", "results/##", "/company/", "Career.aspx", "create/",
    "login/", ".edu/", "current-opening", "current-opening/", "/flowers", "/privacy/", "#purchasing",
)
LISTING_PARTS = (
    "/support-us/", "/ListJobs/ByCustom/Andersen-Job-Category/Keyword-", "employment/search.php?sort=", "/job-openings.php?sort=", "jb_my_searches&SAVED_SEARCH_ID=", "/jobtype/",
    "/jobindustry/", "/jobcategory/", "jb_search_results", "results_page=", "jobs?page=", "com/job-categories", "?pagesize=", "/page-", "download", "/downloads/", "/introduction/",
    "/products", "terms-of-use", "contact-us", "product-category", "/sustainability/", "meet-our-people", "site-support", "why-work-us", "investors-media", "/media-contacts/",
    "/media-library", "our-business", "/professional-areas/", "/terms-use/", "/our-stories", "webSyncID=", "/products/", "sort_by=", "/creative/", "view-all-our-open-jobs",
    "maps?q=", "&pageno=", "aboutus", "contactus", "sign-in", "/social-responsibility/", "/jobs/job-search/", "/postings/all", "/bookmarks?", "CareerOpportunities.html", "/fr/",
    "/search?", "/intro?", "jobsearch.asp", "/product/", "?pr=", "?ss=", "maps.google", "/ways-to-give/", "/news/", "/volunteer/", "page_job=", "/jobs/resume", "&pagenum=",
    "?pageNum=", "page_jobs=", "/jobsearch.ftl", "/joblist.rss", "plus.google.com", "googleads.g.doubleclick.net", "page_jobs=", "?facetcategory=", "?facetcategory=",
    "?facetcountry=", "/listings.html", "&pageNum=", "pages=", "/jobs/in/", "jobOffset=", "?folderOffset=", "&paged=", "#page-", "?pg=", "PGNO=", "startrow=", "startRow=", "#||||",
    "|||||", "pagenumber=", "Pagenumber=", "pageNumber=", "/contact-us/", "/community/", "/research/", "//goo.gl/", "//t.co/", "//buff.ly/", "http://bit.ly/", "//ow.ly/", "#tab-",
    "/property/", "/property-search/", "request-form", "com/idx/", "/catalog", "BrowseAllJobsby", "/member/", "reqtemplate", "GetAQuote&pageName", "apply_now?", "blog#",
    "-PriceWatch&pageNam", "Click&ZoneID", "play.google", "/for-sale/", "manage/optin", "/jobs/in/",
)

#: The pagers, in order of trial; all but one are looked for in any case of letters.
PAGERS = (
    r"Showing Jobs (\d{1,5}) - (\d{1,5}) of (\d{1,5})",
    r"Showing Job (\d{1,5}) - (\d{1,5}) of (\d{1,5})",
    r"Search Results Page (\d{1,5}) of (\d{1,5})",
    r"Showing (\d{1,5}) to (\d{1,5}) of (\d{1,5}) results",
    r"Showing (\d{1,5})-(\d{1,5}) of (\d{1,5})",
    r"Job Openings (\d{1,5})-(\d{1,5}) of (\d{1,5})",
    r"Displaying (\d{1,5})-(\d{1,5}) of (\d{1,5})",
    r"Displaying: (\d{1,5}) - (\d{1,5}) of (\d{1,5})",
    r"Showing (\d{1,5}) of (\d{1,5}) opportunities",
    r"Showing (\d{1,5}) of (\d{1,5})",
    r"Showing (\d{1,5}) - (\d{1,5}) of (\d{1,5}) total Positions",
    r"Showing (\d{1,5}) of (\d{1,5}) jobs",
    r"Showing (\d{1,5}) of (\d{1,5}) job",
    r"Showing (\d{1,5})-(\d{1,5}) of (\d{1,5})",
    r"Showing positions (\d{1,5}) to (\d{1,5}) of (\d{1,5})  matches",
    r"Showing (\d{1,5}) to (\d{1,5}) of (\d{1,5}) jobs",
    r"Showing (\d{1,5}) to (\d{1,5}) of (\d{1,5})",
    r"Showing (\d{1,5})–(\d{1,5}) of (\d{1,5}) results",
    r"(?-i)(\d{1,5}) of (\d{1,5}) Job Opportunities",
    r"(\d{1,5})-(\d{1,5}) of (\d{1,5}) Next",
    r"(\d{1,5}) to (\d{1,5}) of (\d{1,5}) result",
    r"Viewing (\d{1,5})-(\d{1,5}) of (\d{1,5}) jobs",
    r"viewing (\d{1,5}) - (\d{1,5}) of (\d{1,5})",
    r"Viewing (\d{1,5}) – (\d{1,5}) of (\d{1,5}) jobs",
    r"Displaying (\d{1,5})-(\d{1,5}) of (\d{1,5})",
    r"Displaying (\d{1,5}) - (\d{1,5}) of (\d{1,5})",
    r"Showing (\d{1,5}) to (\d{1,5}) of (\d{1,5}) entries",
    r"Job Openings (\d{1,5}) - (\d{1,5}) of (\d{1,5})",
    r"Displaying (\d{1,5}) - (\d{1,5}) of (\d{1,5}) in total",
    r"Showing (\d{1,5}) to (\d{1,5}) of (\d{1,5}) job openings",
    r"Results (\d{1,5}) – (\d{1,5}) of (\d{1,5})",
    r"Showing (\d{1,5})-(\d{1,5}) of (\d{1,5}) jobs",
    r"(\d{1,5}) to (\d{1,5}) of (\d{1,5}) jobs that match your criteria",
    r"Search Results\tFirst  (\d{1,5})-(\d{1,5}) of (\d{1,5})   Last",
    r"Showing (\d{1,5}) - (\d{1,5}) of (\d{1,5})",
    r"Jobs (\d{1,5}) - (\d{1,5}) of (\d{1,5})",
    r"Page: (\d{1,5}) of (\d{1,5})",
    r"(\d{1,5}) - (\d{1,5}) of (\d{1,5}) Records",
    r"(\d{1,5}) of (\d{1,5}) Job Opportunities",
    r"(\d{1,5}) - (\d{1,5}) of (\d{1,5}\,\d{1,5})",
    r"(\d{1,5}) - (\d{1,5}) of (\d{1,5}) Jobs",
    r"(\d{1,5})- (\d{1,5}) of (\d{1,5}) Jobs",
    r"(\d{1,5}) - (\d{1,5}) of (\d{1,5}) items",
    r"(\d{1,5})-(\d{1,5}) of (\d{1,5})",
    r"Jobs (\d{1,5}) to (\d{1,5}) of (\d{1,5})",
    r"Record (\d{1,5})-(\d{1,5}) of (\d{1,5})",
    r"Record (\d{1,5}) - (\d{1,5}) of (\d{1,5})",
    r"Showing (\d{1,5}) - (\d{1,5}) of (\d{1,5})",
    r"Page (\d{1,5}) out of (\d{1,5})",
    r"Displaying (\d{1,5}) to (\d{1,5}) of (\d{1,5})",
    r"(\d{1,5}) - (\d{1,5}) Results of (\d{1,5})",
    r"(\d{1,5}) to (\d{1,5}) of (\d{1,5})",
    r"(\d{1,5}) - (\d{1,5}) of (\d{1,5})",
)

#: Our own list of phrases that say a posting is gone; callers give theirs.
EXPIRY_PHRASES = ("no longer available", "position has been filled", "job has expired", "no current openings", "no open positions", "posting is closed", "page not found", "no jobs found")


@dataclass(frozen=True)
class RuleSet:
    strong: tuple[str, ...] = STRONG_JOB_CONFIGURED
    weak: tuple[str, ...] = WEAK_JOB
    excluded: tuple[str, ...] = EXCLUDED_JOB_CONFIGURED
    non_career: tuple[str, ...] = EXCLUDED_JOB_CONFIGURED
    non_job_text: tuple[str, ...] = tuple(x for x in NON_JOB_TEXT if x != "connect with us")
    job_text: tuple[str, ...] = JOB_TEXT
    excluded_hosts: tuple[str, ...] = EXCLUDED_HOSTS
    social: tuple[str, ...] = SOCIAL
    expiry: tuple[str, ...] = EXPIRY_PHRASES


CONFIGURED = RuleSet()
BUILT_IN = RuleSet(STRONG_JOB, WEAK_JOB, EXCLUDED_JOB, NON_CAREER, NON_JOB_TEXT)
