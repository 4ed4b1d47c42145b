"""Our own résumé-like lines. The generated documents hold almost none of the words the rules look for, so each
document gets one of these appended; both engines pick it by the same rule."""

SNIPPETS = [
    "Summary: result-oriented analyst with 6 years of experience.\n- Built python dashboards with SQL\n- Improved reporting by 20%\n- Led stakeholder analytics\n- Managed a database roadmap\nalex@example.com linkedin.com/in/alex\nBachelor degree, University 2015, gpa 3.8. Jan 2019, Feb 2020",
    "Objective: junior role.\n* Helped with rosters of the night shift\n* Assisted on testing work, teh managment was new\nPhone +1 (555) 010-2030\nHigh school, then college 2018 - 2020",
    "Work history: field technician, 2011 - 2014. Tower engineer, 2014 - 2023.\n- Developed react and node services\n- Designed rest apis with flask\nportfolio on github.com, must have version control; experience with javascript and css",
    "Education: Master of Science, 2010 to 2014, university diploma.\nExcel, pivot table, power bi, communication, git",
    "High school graduate, no other school. Responsible for shelves and the till, every single day",
    "Manager at a company from March 2012 until present\n• Reduced cost by 15%\n• Launched two products\n• Delivered training\nContact: kim.lee@example.org, portfolio available. Dec 2012, apr 2020",
    "Technical documentation, presentation, problem solving, teamwork and leadership on one project.\nParticipated in machine learning with sklearn, handled pandas dataframes",
    "Experience: 3 yrs. Proficient in python, pytest and git; experience with natural language processing.\n- created bert models\nAchievements: phd, 2021",
    "",
    "Consultant, 2001 - 2009 and 2005 - 2012; analyst experience, Oct 2013 - now\n- engineered transformers\n- achieved 40% growth\nsummary objective achievements",
    "Worked on html5 pages with responsive design\nworked on qa automation, recieve and acheive seperated\n- data visualization with seaborn - tableau - matplotlib",
    "40 years of experience in adaptability, organization and collaboration. Bug reports, data analysis, testing",
    "Bachelor of Arts, high school tutor. Shipped, streamlined and optimized things; mentored people",
]

TITLES = ["Data Analyst", "full stack developer", None, "Senior Software Engineer", "Product Manager", "Technical Writer", ""]

REQUIREMENTS = [
    "Required python, sql and tableau. Experience with stakeholder reporting.",
    "Must have javascript, react and node; responsible for rest api testing.",
    "",
]

EXTENSIONS = ["pdf", "docx", "txt"]
AS_OF_YEAR = 2026
