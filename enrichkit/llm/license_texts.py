"""Licence notices and short licence texts, by template name, for operator 7.

Of the longer licences the notices and the opening are listed. Wordings and
licences that are not listed are not found.
"""

#: Fixed values, besides the templates in ``license_scan``.
NOTICES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it will be "
        "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "AGPL-3.0-notice": "licensed under the GNU Affero General Public License v3.0",
    "AGPL-3.0-spdx": "SPDX-License-Identifier: AGPL-3.0",
    "Apache-2.0-notice": "licensed under the Apache License 2.0",
    "Apache-2.0-spdx": "SPDX-License-Identifier: Apache-2.0",
    "BSD-2-Clause-notice": "licensed under the BSD 2-Clause License",
    "BSD-2-Clause-spdx": "SPDX-License-Identifier: BSD-2-Clause",
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
        'COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
        "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF "
        "SUCH DAMAGE."
    ),
    "BSD-3-Clause-notice": "licensed under the BSD 3-Clause License",
    "BSD-3-Clause-spdx": "SPDX-License-Identifier: BSD-3-Clause",
    "BSD-3-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT"
        ' HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
        "EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
        "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSL-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
    "BSL-1.0-spdx": "SPDX-License-Identifier: BSL-1.0",
    "CC-BY-3.0": "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
    "CC-BY-3.0-short": "Licensed under CC BY 3.0.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-spdx": "SPDX-License-Identifier: CC-BY-4.0",
    "CC-BY-NC-3.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 3.0 Unported License.",
    "CC-BY-NC-3.0-short": "Licensed under CC BY-NC 3.0.",
    "CC-BY-NC-4.0-deed": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ),
    "CC-BY-NC-4.0-spdx": "SPDX-License-Identifier: CC-BY-NC-4.0",
    "CC-BY-NC-ND-3.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported License."
    ),
    "CC-BY-NC-ND-3.0-short": "Licensed under CC BY-NC-ND 3.0.",
    "CC-BY-NC-ND-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International"
        " License."
    ),
    "CC-BY-NC-ND-4.0-short": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-3.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported "
        "License."
    ),
    "CC-BY-NC-SA-3.0-short": "Licensed under CC BY-NC-SA 3.0.",
    "CC-BY-NC-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
        "License."
    ),
    "CC-BY-NC-SA-4.0-short": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-ND-3.0": "This work is licensed under a Creative Commons Attribution-NoDerivs 3.0 Unported License.",
    "CC-BY-ND-3.0-short": "Licensed under CC BY-ND 3.0.",
    "CC-BY-ND-4.0": (
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."
    ),
    "CC-BY-ND-4.0-short": "Licensed under CC BY-ND 4.0.",
    "CC-BY-SA-3.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "CC-BY-SA-3.0-short": "Licensed under CC BY-SA 3.0.",
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0-spdx": "SPDX-License-Identifier: CC-BY-SA-4.0",
    "CC0-1.0-notice": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring"
        " rights to this software to the public domain worldwide. This software is distributed without any "
        "warranty."
    ),
    "CC0-1.0-spdx": "SPDX-License-Identifier: CC0-1.0",
    "EPL-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"
    ),
    "EPL-2.0-spdx": "SPDX-License-Identifier: EPL-2.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 2 of the License, or"
        " (at your option) any later version. This program is distributed in the hope that it will be useful, but"
        " WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."
    ),
    "GPL-2.0-notice": "licensed under the GNU General Public License v2.0",
    "GPL-2.0-spdx": "SPDX-License-Identifier: GPL-2.0",
    "GPL-3.0-notice": "licensed under the GNU General Public License v3.0",
    "GPL-3.0-spdx": "SPDX-License-Identifier: GPL-3.0",
    "ISC-notice": "licensed under the ISC License",
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all "
        'copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR "
        "BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
        "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the "
        "License, or (at your option) any later version. This library is distributed in the hope that it will be "
        "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "LGPL-2.1-notice": "licensed under the GNU Lesser General Public License v2.1",
    "LGPL-2.1-spdx": "SPDX-License-Identifier: LGPL-2.1",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version. This library is distributed in the hope that it will be "
        "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "LGPL-3.0-notice": "licensed under the GNU Lesser General Public License v3.0",
    "LGPL-3.0-spdx": "SPDX-License-Identifier: LGPL-3.0",
    "LGPL-3.0-text": (
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3"
        " of the GNU General Public License, supplemented by the additional permissions listed below."
    ),
    "MIT-notice": "licensed under the MIT License",
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "MPL-2.0-notice": "licensed under the Mozilla Public License 2.0",
    "MPL-2.0-spdx": "SPDX-License-Identifier: MPL-2.0",
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors"
        " be held liable for any damages arising from the use of this software. Permission is granted to anyone "
        "to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions:"
    ),
}

#: How the longer licences begin (about 300 words), by which a whole copy is known.
OPENINGS = {
    "AGPL-3.0-preamble": (
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
        "specifically designed to ensure cooperation with the community in the case of network server software. "
        "The licenses for most software and other practical works are designed to take away your freedom to share "
        "and change the works. By contrast, our General Public Licenses are intended to guarantee your freedom to "
        "share and change all versions of a program--to make sure it remains free software for all its users. "
        "When we speak of free software, we are referring to freedom, not price. Our General Public Licenses are "
        "designed to make sure that you have the freedom to distribute copies of free software (and charge for "
        "them if you wish), that you receive source code or can get it if you want it, that you can change the "
        "software or use pieces of it in new free programs, and that you know you can do these things. Developers "
        "that use our General Public Licenses protect your rights with two steps: (1) assert copyright on the "
        "software, and (2) offer you this License which gives you legal permission to copy, distribute and/or "
        "modify the software. A secondary benefit of defending all users' freedom is that improvements made in "
        "alternate versions of the program, if they receive widespread use, become available for other developers "
        "to incorporate. "
    ),
    "Apache-2.0-terms": (
        '"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by '
        'Sections 1 through 9 of this document. "Licensor" shall mean the copyright owner or entity authorized by '
        'the copyright owner that is granting the License. "Legal Entity" shall mean the union of the acting '
        "entity and all other entities that control, are controlled by, or are under common control with that "
        'entity. For the purposes of this definition, "control" means (i) the power, direct or indirect, to cause '
        "the direction or management of such entity, whether by contract or otherwise, or (ii) ownership of fifty "
        'percent (50%) or more of the outstanding shares, or (iii) beneficial ownership of such entity. "You" (or '
        '"Your") shall mean an individual or Legal Entity exercising permissions granted by this License. '
        '"Source" form shall mean the preferred form for making modifications, including but not limited to '
        'software source code, documentation source, and configuration files. "Object" form shall mean any form '
        "resulting from mechanical transformation or translation of a Source form, including but not limited to "
        'compiled object code, generated documentation, and conversions to other media types. "Work" shall mean '
        "the work of authorship, whether in Source or Object form, made available under the License, as indicated "
        "by a copyright notice that is included in or attached to the work (an example is provided in the "
        'Appendix below). "Derivative Works" shall mean any work, whether in Source or Object form, that is based '
        "on (or derived from) the Work and for which the editorial revisions, annotations, elaborations, or other "
        "modifications represent, as a whole, an original work of authorship. For the purposes of this License, "
        "Derivative Works shall not include works that remain separable from, or merely link (or bind by name) to "
        "the interfaces of, the Work and Derivative Works "
    ),
    "Artistic-1.0-text": (
        "The intent of this document is to state the conditions under which a Package may be copied, such that "
        "the Copyright Holder maintains some semblance of artistic control over the development of the package, "
        "while giving the users of the package the right to use and distribute the Package in a more-or-less "
        'customary fashion, plus the right to make reasonable modifications. Definitions: "Package" refers to the '
        "collection of files distributed by the Copyright Holder, and derivatives of that collection of files "
        'created through textual modification. "Standard Version" refers to such a Package if it has not been '
        "modified, or has been modified in accordance with the wishes of the Copyright Holder as specified below. "
        '"Copyright Holder" is whoever is named in the copyright or copyrights for the package. "You" is you, if '
        "you're thinking about copying or distributing this Package. \"Reasonable copying fee\" is whatever you can "
        "justify on the basis of media cost, duplication charges, time of people involved, and so on. (You will "
        "not be required to justify it to the Copyright Holder, but only to the computing community at large as a "
        'market that must bear the fee.) "Freely Available" means that no fee is charged for the item itself, '
        "though there may be fees involved in handling the item. It also means that recipients of the item may "
        "redistribute it under the same conditions they received it. 1. You may make and give away verbatim "
        "copies of the source form of the Standard Version of this Package without restriction, provided that you "
        "duplicate all of the original copyright notices and associated disclaimers. 2. You may apply bug fixes, "
        "portability fixes and other modifications derived from the Public Domain or from the Copyright Holder. A "
        "Package modified in such a way shall still be considered the Standard "
    ),
    "CC0-1.0-text": (
        "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related "
        'Rights (defined below) upon the creator and subsequent owner(s) (each and all, an "owner") of an '
        'original work of authorship and/or a database (each, a "Work"). Certain owners wish to permanently '
        "relinquish those rights to a Work for the purpose of contributing to a commons of creative, cultural and "
        'scientific works ("Commons") that the public can reliably and without fear of later claims of '
        "infringement build upon, modify, incorporate in other works, reuse and redistribute as freely as "
        "possible in any form whatsoever and for any purposes, including without limitation commercial purposes. "
        "These owners may contribute to the Commons to promote the ideal of a free culture and the further "
        "production of creative, cultural and scientific works, or to gain reputation or greater distribution for "
        "their Work in part through the use and efforts of others. For these and/or other purposes and "
        "motivations, and without any expectation of additional consideration or compensation, the person "
        'associating CC0 with a Work (the "Affirmer"), to the extent that he or she is an owner of Copyright and '
        "Related Rights in the Work, voluntarily elects to apply CC0 to the Work and publicly distribute the Work "
        "under its terms, with knowledge of his or her Copyright and Related Rights in the Work and the meaning "
        "and intended legal effect of CC0 on those rights. 1. Copyright and Related Rights. A Work made available "
        'under CC0 may be protected by copyright and related or neighboring rights ("Copyright and Related '
        'Rights"). Copyright and Related Rights include, but are not limited to, the following: i. the right to '
        "reproduce, adapt, distribute, perform, display, communicate, and translate a Work; ii. moral rights "
        "retained by the original author(s) and/or performer(s); iii. publicity and privacy rights "
    ),
    "GFDL-1.3-text": (
        "The purpose of this License is to make a manual, textbook, or other functional and useful document "
        '"free" in the sense of freedom: to assure everyone the effective freedom to copy and redistribute it, '
        "with or without modifying it, either commercially or noncommercially. Secondarily, this License "
        "preserves for the author and publisher a way to get credit for their work, while not being considered "
        'responsible for modifications made by others. This License is a kind of "copyleft", which means that '
        "derivative works of the document must themselves be free in the same sense. It complements the GNU "
        "General Public License, which is a copyleft license designed for free software. We have designed this "
        "License in order to use it for manuals for free software, because free software needs free "
        "documentation: a free program should come with manuals providing the same freedoms that the software "
        "does. But this License is not limited to software manuals; it can be used for any textual work, "
        "regardless of subject matter or whether it is published as a printed book. We recommend this License "
        "principally for works whose purpose is instruction or reference. 1. APPLICABILITY AND DEFINITIONS This "
        "License applies to any manual or other work, in any medium, that contains a notice placed by the "
        "copyright holder saying it can be distributed under the terms of this License. Such a notice grants a "
        "world-wide, royalty-free license, unlimited in duration, to use that work under the conditions stated "
        'herein. The "Document", below, refers to any such manual or work. Any member of the public is a '
        'licensee, and is addressed as "you". You accept the license if you copy, modify or distribute the work '
        'in a way requiring permission under copyright law. A "Modified Version" of the Document means any work '
        "containing the Document or "
    ),
    "GPL-2.0-preamble": (
        "The licenses for most software are designed to take away your freedom to share and change it. By "
        "contrast, the GNU General Public License is intended to guarantee your freedom to share and change free "
        "software--to make sure the software is free for all its users. This General Public License applies to "
        "most of the Free Software Foundation's software and to any other program whose authors commit to using "
        "it. (Some other Free Software Foundation software is covered by the GNU Lesser General Public License "
        "instead.) You can apply it to your programs, too. When we speak of free software, we are referring to "
        "freedom, not price. Our General Public Licenses are designed to make sure that you have the freedom to "
        "distribute copies of free software (and charge for this service if you wish), that you receive source "
        "code or can get it if you want it, that you can change the software or use pieces of it in new free "
        "programs; and that you know you can do these things. To protect your rights, we need to make "
        "restrictions that forbid anyone to deny you these rights or to ask you to surrender the rights. These "
        "restrictions translate to certain responsibilities for you if you distribute copies of the software, or "
        "if you modify it. For example, if you distribute copies of such a program, whether gratis or for a fee, "
        "you must give the recipients all the rights that you have. You must make sure that they, too, receive or "
        "can get the source code. And you must show them these terms so they know their rights. We protect your "
        "rights with two steps: (1) copyright the software, and (2) offer you this license which gives you legal "
        "permission to copy, distribute and/or modify the software. Also, "
    ),
    "GPL-3.0-preamble": (
        "The GNU General Public License is a free, copyleft license for software and other kinds of works. The "
        "licenses for most software and other practical works are designed to take away your freedom to share and "
        "change the works. By contrast, the GNU General Public License is intended to guarantee your freedom to "
        "share and change all versions of a program--to make sure it remains free software for all its users. We, "
        "the Free Software Foundation, use the GNU General Public License for most of our software; it applies "
        "also to any other work released this way by its authors. You can apply it to your programs, too. When we "
        "speak of free software, we are referring to freedom, not price. Our General Public Licenses are designed "
        "to make sure that you have the freedom to distribute copies of free software (and charge for them if you "
        "wish), that you receive source code or can get it if you want it, that you can change the software or "
        "use pieces of it in new free programs, and that you know you can do these things. To protect your "
        "rights, we need to prevent others from denying you these rights or asking you to surrender the rights. "
        "Therefore, you have certain responsibilities if you distribute copies of the software, or if you modify "
        "it: responsibilities to respect the freedom of others. For example, if you distribute copies of such a "
        "program, whether gratis or for a fee, you must pass on to the recipients the same freedoms that you "
        "received. You must make sure that they, too, receive or can get the source code. And you must show them "
        "these terms so they know their rights. Developers that use the GNU GPL protect your rights with two "
        "steps: (1) assert copyright "
    ),
    "LGPL-2.1-preamble": (
        "The licenses for most software are designed to take away your freedom to share and change it. By "
        "contrast, the GNU General Public Licenses are intended to guarantee your freedom to share and change "
        "free software--to make sure the software is free for all its users. This license, the Lesser General "
        "Public License, applies to some specially designated software packages--typically libraries--of the Free "
        "Software Foundation and other authors who decide to use it. You can use it too, but we suggest you first "
        "think carefully about whether this license or the ordinary General Public License is the better strategy "
        "to use in any particular case, based on the explanations below. When we speak of free software, we are "
        "referring to freedom of use, not price. Our General Public Licenses are designed to make sure that you "
        "have the freedom to distribute copies of free software (and charge for this service if you wish); that "
        "you receive source code or can get it if you want it; that you can change the software and use pieces of "
        "it in new free programs; and that you are informed that you can do these things. To protect your rights, "
        "we need to make restrictions that forbid distributors to deny you these rights or to ask you to "
        "surrender these rights. These restrictions translate to certain responsibilities for you if you "
        "distribute copies of the library or if you modify it. For example, if you distribute copies of the "
        "library, whether gratis or for a fee, you must give the recipients all the rights that we gave you. You "
        "must make sure that they, too, receive or can get the source code. If you link other code with the "
        "library, you must provide complete object files to the recipients, so that they can relink "
    ),
    "LGPL-3.0-terms": (
        'As used herein, "this License" refers to version 3 of the GNU Lesser General Public License, and the '
        '"GNU GPL" refers to version 3 of the GNU General Public License. "The Library" refers to a covered work '
        "governed by this License, other than an Application or a Combined Work as defined below. An "
        '"Application" is any work that makes use of an interface provided by the Library, but which is not '
        "otherwise based on the Library. Defining a subclass of a class defined by the Library is deemed a mode "
        'of using an interface provided by the Library. A "Combined Work" is a work produced by combining or '
        "linking an Application with the Library. The particular version of the Library with which the Combined "
        'Work was made is also called the "Linked Version". The "Minimal Corresponding Source" for a Combined '
        "Work means the Corresponding Source for the Combined Work, excluding any source code for portions of the "
        "Combined Work that, considered in isolation, are based on the Application, and not on the Linked "
        'Version. The "Corresponding Application Code" for a Combined Work means the object code and/or source '
        "code for the Application, including any data and utility programs needed for reproducing the Combined "
        "Work from the Application, but excluding the System Libraries of the Combined Work. 1. Exception to "
        "Section 3 of the GNU GPL. You may convey a covered work under sections 3 and 4 of this License without "
        "being bound by section 3 of the GNU GPL. 2. Conveying Modified Versions. If you modify a copy of the "
        "Library, and, in your modifications, a facility refers to a function or data to be supplied by an "
        "Application that uses the facility (other than as an argument passed when the facility is invoked), then "
        "you may convey a copy "
    ),
    "MPL-1.1-terms": (
        '"Commercial Use" means distribution or otherwise making the Covered Code available to a third party. '
        '1.1. "Contributor" means each entity that creates or contributes to the creation of Modifications. 1.2. '
        '"Contributor Version" means the combination of the Original Code, prior Modifications used by a '
        'Contributor, and the Modifications made by that particular Contributor. 1.3. "Covered Code" means the '
        "Original Code or Modifications or the combination of the Original Code and Modifications, in each case "
        'including portions thereof. 1.4. "Electronic Distribution Mechanism" means a mechanism generally '
        'accepted in the software development community for the electronic transfer of data. 1.5. "Executable" '
        'means Covered Code in any form other than Source Code. 1.6. "Initial Developer" means the individual or '
        'entity identified as the Initial Developer in the Source Code notice required by Exhibit A. 1.7. "Larger '
        'Work" means a work which combines Covered Code or portions thereof with code not governed by the terms '
        'of this License. 1.8. "License" means this document. 1.8.1. "Licensable" means having the right to '
        "grant, to the maximum extent possible, whether at the time of the initial grant or subsequently "
        'acquired, any and all of the rights conveyed herein. 1.9. "Modifications" means any addition to or '
        "deletion from the substance or structure of either the Original Code or any previous Modifications. When "
        "Covered Code is released as a series of files, a Modification is: A. Any addition to or deletion from "
        "the contents of a file containing Original Code or previous Modifications. B. Any new file that contains "
        'any part of the Original Code or previous Modifications. 1.10. "Original Code" means Source Code of '
        "computer software code which is described in the Source Code notice required by Exhibit A as Original "
        "Code, and which, at the time of its release under this License is not already Covered Code "
    ),
    "MPL-2.0-terms": (
        '"Contributor" means each individual or legal entity that creates, contributes to the creation of, or '
        'owns Covered Software. 1.2. "Contributor Version" means the combination of the Contributions of others '
        "(if any) used by a Contributor and that particular Contributor's Contribution. 1.3. \"Contribution\" means "
        'Covered Software of a particular Contributor. 1.4. "Covered Software" means Source Code Form to which '
        "the initial Contributor has attached the notice in Exhibit A, the Executable Form of such Source Code "
        "Form, and Modifications of such Source Code Form, in each case including portions thereof. 1.5. "
        '"Incompatible With Secondary Licenses" means (a) that the initial Contributor has attached the notice '
        "described in Exhibit B to the Covered Software; or (b) that the Covered Software was made available "
        "under the terms of version 1.1 or earlier of the License, but not also under the terms of a Secondary "
        'License. 1.6. "Executable Form" means any form of the work other than Source Code Form. 1.7. "Larger '
        'Work" means a work that combines Covered Software with other material, in a separate file or files, that '
        'is not Covered Software. 1.8. "License" means this document. 1.9. "Licensable" means having the right to '
        "grant, to the maximum extent possible, whether at the time of the initial grant or subsequently, any and "
        'all of the rights conveyed by this License. 1.10. "Modifications" means any of the following: (a) any '
        "file in Source Code Form that results from an addition to, deletion from, or modification of the "
        "contents of Covered Software; or (b) any new file in Source Code Form that contains any Covered "
        'Software. 1.11. "Patent Claims" of a Contributor means any patent claim(s), including without '
        "limitation, method, process, and apparatus claims, in any patent Licensable by such Contributor that "
        "would be infringed, but for the grant of the License, by the "
    ),
}

#: Tags and phrases of one to four words, found as a word sequence.
PHRASES = {
    "AGPL-3.0-v": "under the AGPLv3",
    "GPL-2.0-later": "GPLv2 or later",
    "GPL-2.0-v": "under the GPLv2",
    "GPL-3.0-later": "GPLv3 or later",
    "GPL-3.0-v": "under the GPLv3",
    "ISC-spdx": "SPDX-License-Identifier: ISC",
    "LGPL-2.1-v": "under the LGPLv2.1",
    "LGPL-3.0-v": "under the LGPLv3",
    "MIT-spdx": "SPDX-License-Identifier: MIT",
    "Unlicense-spdx": "SPDX-License-Identifier: Unlicense",
    "Zlib-spdx": "SPDX-License-Identifier: Zlib",
}
